"""Licence scan by canonical digest lookup.

A text and a known licence are the same when their canonical forms are: lower
case, letters and digits only, lines of copyright holders left out, equivalent
spellings made one. Whole texts are compared, by digest in a hash join: each
document, and each of its blocks (lines between blank ones) and lines, since a
document may carry a licence as one of them. A licence of several blocks inside
a longer text is found as a run: where its first block occurs, as many blocks
are compared with it by the digest of their digests.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wharf.llm.common import materialise

#: Words that count as one (fixed values).
SPELLINGS = {
    "licence": "license", "licences": "licenses", "licenced": "licensed", "licencing": "licensing",
    "sublicence": "sublicense", "organisation": "organization", "organisations": "organizations",
    "merchantibility": "merchantability", "whilst": "while", "favour": "favor", "honour": "honor",
    "cancelled": "canceled", "acknowledgement": "acknowledgment", "per cent": "percent", "non commercial":
    "noncommercial", "copyright owner": "copyright holder", "https": "http", "v": "version", "ver": "version",
}

#: A canonical line that names a copyright holder.
HOLDER = ("^(?:copyright|c) (?:(?:c )?[0-9]|by |all rights)|^copyright c |^all rights reserved$|"
          "^copyright the .*(?:authors|contributors|developers|foundation|project|team)$")

_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is " \
         "hereby granted"
_AS_IS = "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE " \
         "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR " \
         "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF " \
         "USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT " \
         "OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission.
"""
_BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter
it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software.

3. This notice may not be removed or altered from any source distribution."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
specific language governing permissions and limitations under the License."""
_MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""
#: Known licences and notices: identifier and text (fixed values).
KNOWN: Sequence[tuple[str, str]] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("ISC", f"{_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.\n\n"
            f"{_AS_IS}"),
    ("0BSD", f"{_GRANT}.\n\n{_AS_IS}"),
    ("MIT", _MIT),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    ("Zlib", _ZLIB),
    ("Apache-2.0", _APACHE),
    ("MPL-2.0", _MPL),
)
#: Long licences by their digests, as ``digests`` makes them of the entire published texts: identifier, the whole
#: text's, the first block's, number of blocks, the run's (fixed values).
LONG: Sequence[tuple[str, str, str, int, str]] = (
    ("Apache-2.0", "d03e86ac7a1ff3f8d928e1d6027bfd17", "a1ddb546c320b4b74596d4939840ad46", 33,
     "e7510dd5145faa7b10d747a41fa6fa4c"),
    ("CC0-1.0", "dcb3226ed1c311f82507296410434b55", "7250e6f25e565adb9ab3d5c762aa5853", 13,
     "dda9eb75fa133b0f77717b902bd54ddf"),
    ("GFDL-1.3", "7132e8380bc59358f27c3129a2136bf1", "32ad5ff9440ac2b37b2a23c593a9c93a", 67,
     "ee347a74ae476a0e317634ecdb11a515"),
    ("GPL-2.0", "5e39ace6e62f5a7fe9c17b4da986ad8c", "fd4b084cf055384ebea0b97bf8698773", 59,
     "6dd8d73f936ff9cadbad628084599122"),
    ("GPL-3.0", "b79359b5e391fd47146ff34ae3db7ec0", "25fc66bc78650e01b426a6bc8c0d7545", 122,
     "6f0c6125984318cb9d749f05e4bf7347"),
    ("LGPL-2.1", "f998bc436710cfece156aaa84fd26dd4", "49adf921daa23973c0b7eff8d2a4fccd", 85,
     "47740c030ce5b50f5d2f6721ae08380f"),
    ("LGPL-3.0", "b31b7335bc37919e8cdd79154e04d88d", "4a45b695648627b95fd1b62d7e4ec400", 37,
     "df759404de92650a1e4a78f0c247060f"),
    ("MPL-1.1", "4ed6600fcf5321eb9dcd2181cde18632", "e39b33eaca01596c261216340f546724", 73,
     "659c892f4ecba8ee29a767cb6c339fc5"),
    ("MPL-2.0", "bba58d76f66dd9d890110b970536045e", "376b9be9b3265815b3b9a61efc72b535", 83,
     "1892c86fc192432cc01e16b01ffa25c9"),
)


def canonical_lines(text: Column, spellings: Mapping[str, str] = SPELLINGS) -> Column:
    """Array of a text's canonical lines; blank lines and those of copyright
    holders are '' and null."""
    lines = F.split(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}\\n]+", " "), "\n", -1)

    def one(line: Column) -> Column:
        padded = F.concat(F.lit(" "), F.trim(line), F.lit(" "))
        found = padded.rlike(r" (?:" + "|".join(sorted(spellings, key=len, reverse=True)) + ") ")
        same = padded
        for other, usual in spellings.items():
            same = F.replace(same, F.lit(f" {other} "), F.lit(f" {usual} "))
        holder = F.trim(line).rlike(HOLDER)
        return F.when(~holder, F.trim(F.when(found, same).otherwise(padded)))

    return F.transform(lines, one)


def _across(text: Column) -> Column:
    """Spellings of several words that a line's end had parted."""
    same = F.concat(F.lit(" "), text, F.lit(" "))
    parted = [(other, usual) for other, usual in SPELLINGS.items() if " " in other]
    found = same.rlike(" (?:" + "|".join(other for other, _ in parted) + ") ")
    for other, usual in parted:
        same = F.replace(same, F.lit(f" {other} "), F.lit(f" {usual} "))
    return F.when(found, F.trim(same)).otherwise(text)


def _join(lines: Column) -> Column:
    return _across(F.trim(F.array_join(F.filter(lines, lambda x: x != ""), " ")))


def _blocks(lines: Column) -> Column:
    """Canonical texts of the blocks, blank ones left out."""
    body = F.array_join(lines, "\n")                               # holders' lines are null and left out
    cut = F.transform(F.split(body, "\n\n+", -1), lambda b: _across(F.trim(F.translate(b, "\n", " "))))
    return F.filter(cut, lambda b: b != "")


def digests(texts: DataFrame) -> DataFrame:
    """(licence, digest, first, n, run) of known texts (licence, text): the digest
    of the whole, of its first block, the number of blocks and the digest of
    all their digests."""
    lines = canonical_lines(F.col("text"))
    own = texts.select("licence", F.md5(_join(lines)).alias("digest"), F.transform(_blocks(lines), F.md5).alias("blocks"))
    return own.select("licence", "digest", F.get("blocks", F.lit(0)).alias("first"), F.size("blocks").alias("n"),
                      F.md5(F.array_join("blocks", "")).alias("run"))


def known_digests(spark: SparkSession, known: Sequence[tuple[str, str]] = KNOWN,
                  long: Sequence[tuple[str, str, str, int, str]] = LONG) -> DataFrame:
    """The known texts as ``digests`` has them: a list that comes with the call,
    and so small. Equal digests are one licence, the least by name."""
    own = digests(spark.createDataFrame(list(known), "licence string, text string"))
    if long:
        own = own.unionByName(spark.createDataFrame(list(long), "licence string, digest string, first string, n int, run string"))
    return own.groupBy("digest", "first", "n", "run").agg(F.min("licence").alias("licence"))


def scan(docs: DataFrame, known: DataFrame | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, whole (licence that the entire text
    is, or null), licences (sorted; of the entire text, its blocks, lines or runs
    of blocks), n_matches (units and runs that match) and n_units.

    Units are the entire text, its blocks and its lines. A run counts where a
    known text of several blocks has the same blocks one after the other; with
    other paragraph breaks it is found only as the entire text. Null and empty
    texts and blank lines have no units. Repeated rows and null ids are rows of
    their own. Empty table: no rows. ``known`` has the columns of ``digests``;
    of equal digests the least licence counts.
    """
    known = known_digests(docs.sparkSession) if known is None else known
    lines = canonical_lines(F.col(text))
    rows = docs.select(F.col(key).alias("doc_id"), F.monotonically_increasing_id().alias("row"), lines.alias("lines"))
    single = F.filter("lines", lambda x: x != "")
    whole = _join(F.col("lines"))
    units = materialise(rows.select("doc_id", "row", F.when(whole != "", F.md5(whole)).alias("whole"),
                                    F.transform(_blocks(F.col("lines")), F.md5).alias("blocks"),
                                    F.transform(single, F.md5).alias("lines")), "licence-units")
    texts = known.groupBy("digest").agg(F.min("licence").alias("licence"))
    each = F.concat(F.transform(F.filter(F.array("whole"), lambda x: x.isNotNull()), _unit("whole")),
                    F.transform("blocks", _unit("block")), F.transform("lines", _unit("line")))
    found = units.select("row", F.explode(each).alias("u")).select("row", "u.unit", "u.digest").join(texts, "digest")
    # a run is looked up only where its first block is: the blocks of a text are compared once more, by their digests
    runs = known.where("n > 1").groupBy("first", "n", "run").agg(F.min("licence").alias("licence"))
    starts = (units.select("row", F.posexplode("blocks").alias("at", "first")).join(runs, "first")
              .select("row", "at", "n", "run", "licence"))
    same = F.md5(F.array_join(F.slice("blocks", F.col("at") + 1, F.col("n")), "")) == F.col("run")
    several = units.select("row", "blocks").join(starts, "row").where(same).select("row", F.lit("run").alias("unit"), "licence")
    found = (found.select("row", "unit", "licence").unionByName(several).groupBy("row")
             .agg(F.max(F.when(F.col("unit") == "whole", F.col("licence"))).alias("whole"),
                  F.array_sort(F.collect_set("licence")).alias("licences"), F.count("*").alias("n_matches")))
    size = F.size("blocks") + F.size("lines") + F.when(F.col("whole").isNull(), 0).otherwise(1)
    return (units.select("doc_id", "row", size.cast("long").alias("n_units"))
            .join(found, "row", "left")
            .select("doc_id", "whole", F.coalesce("licences", F.array().cast("array<string>")).alias("licences"),
                    F.coalesce("n_matches", F.lit(0)).cast("long").alias("n_matches"), "n_units"))


def _unit(name: str):
    return lambda digest: F.struct(F.lit(name).alias("unit"), digest.alias("digest"))
