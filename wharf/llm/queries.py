"""Registered queries of the document operators, one for each, and their SQL.

``queries()`` and ``oracle_sql()`` are what the entry module adds to its own.
Every query reads its whole tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wharf.llm import (conversation_repair, decontamination, exact_dedup, fingerprints, licences, line_dedup, manifest, mixing, near_dedup,
                       oracles, quality, sharding, successors, token_counts, tool_calls)
from wharf.llm.common import ROW, count_words, materialise, read

SHARDS = 24
#: What a redaction pass takes out of the texts whose tokens op7 counts: e-mail addresses and long numbers.
REDACTED = r"(?<![\w.+-])[\w.+-]++@[\w.-]+|(?<!\d)\d(?:[ -]?\d){6,}"
#: Schemas of the tools that op1's calls name.
TOOLS = {"search": {"query": ("string", True), "limit": ("integer", False)},
         "fetch": {"url": ("string", True), "depth": ("integer", True)},
         "note": {"text": ("string", True), "pinned": ("boolean", False)}}


def conversation_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tool calls and results read out of the given turns, which have none of
    their own: a user's turn is a call whose arguments hold its text (with
    missing, ill-typed and unknown fields and an unknown tool by rules on its
    length), an assistant's turn the result of the turn before. A call depends on
    the call two turns back, some also on the one two turns on, which makes cycles."""
    name = lambda turn: F.concat(F.lit("call_"), F.col("conv_id"), F.lit("_"), turn)
    n, turn = F.length("text"), F.col("turn")
    quoted = F.to_json(F.array("text"))
    quoted = F.substring(quoted, F.lit(2), F.length(quoted) - 2)
    tool = F.when(n % 29 == 0, "paint").when(n % 3 == 0, "search").when(n % 3 == 1, "fetch").otherwise("note")
    arguments = (F.when(n % 3 == 0, F.concat(F.lit('{ "query": '), quoted, F.lit(', "limit" : '), F.when(
        n % 7 == 0, F.concat(F.lit('"'), n, F.lit('"'))).otherwise(n.cast("string")), F.lit("}")))
        .when(n % 3 == 1, F.concat(F.lit('{"url": '), quoted, F.when(n % 5 == 0, "").otherwise(
            F.concat(F.lit(', "depth": '), n)), F.lit(" }")))
        .otherwise(F.concat(F.lit('{"text": '), quoted, F.when(n % 2 == 0, ', "colour": 1').otherwise(
            ', "pinned": true'), F.when(n % 13 == 0, "").otherwise("}"))))
    depends = F.filter(F.array(F.when(turn % 3 != 0, name(turn - 2)), F.when(turn % 5 == 4, name(turn + 2))),
                       lambda x: x.isNotNull())
    calls = conversations.where("role = 'user'").select(
        "conv_id", "turn", name(turn).alias("call_id"), tool.alias("tool"), arguments.alias("arguments"),
        depends.alias("depends_on"))
    results = conversations.where("role = 'assistant'").select(
        name(turn - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


def op1_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tool_calls.link(*conversation_calls(read(spark, sf_dir, "conversations")), TOOLS)


def op2_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(read(spark, sf_dir, "documents"))
    return found.withColumn("licences", F.array_join("licences", ","))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts go through the mix and its range sort; sizes are those of the sorted texts."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.curriculum(docs, count_words(F.col("text")))
    ordered = (mixed.select("doc_id", "text", "source_size", "target", "taken",
                            F.get("positions", F.lit(0)).alias("first_position"))
               .orderBy("first_position", "doc_id"))         # what is never taken would else be one range
    return ordered.select("doc_id", count_words(F.col("text")).alias("size"), "source_size", "target", "taken",
                          "first_position")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts go through both passes into the shard files; sizes and checksums are those of the files' texts."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    size = (F.octet_length(text) + 8).cast("long")
    written = sharding.written_shards(sharding.shard(docs, SHARDS, size))
    return written.select("doc_id", size.alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), "law",
                          "shard", "slot", "grown_shard")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (exact_dedup.exact_groups(read(spark, sf_dir, "documents"))
            .select("doc_id", "keep_id", "group_size", "kept", "text_sha256"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return (line_dedup.drop_common_lines(docs)
            .select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    trees = materialise(token_counts.build_trees(read(spark, sf_dir, "documents")), "token-trees")
    edited = token_counts.apply_edits(trees, pattern=REDACTED, replacement="<x>")
    return edited.select("doc_id", "n_tokens_before", "n_tokens", "n_edits", "n_leaves", "n_encoded")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return (decontamination.mark_benchmark(docs, read(spark, sf_dir, "benchmark"))
            .select("doc_id", "n_words", "n_hit", "n_items",
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults by crc32 of ``conv_id:turn``; nulls count as one space."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"),
                                fault.alias("fault"))
    return rows.where("fault <> 0").select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))


_REPAIRED = T.StructType([T.StructField("conv", T.LongType()), T.StructField("audit", T.StringType()),
                          T.StructField("repaired_sha256", T.StringType())])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edit initials and digest of each repaired conversation, row by row out of the sorted edits."""
    done: list[tuple] = []
    conv, audit, digest = None, [], None
    for b in batches:
        for c, edit, role, text in zip(*[b.column(k).to_pylist() for k in ("conv", "edit", "role", "text")], strict=True):
            if not audit or c != conv:
                if audit:
                    done.append((conv, "".join(audit), digest.hexdigest()))
                conv, audit, digest, begun = c, [], sha256(), False
            audit.append(edit)
            if edit != "D":
                digest.update(f"{chr(10) * begun}{role}:{text}".encode())
                begun = True
        if len(done) >= 1000:
            yield _rows(done)
            done = []
    if audit:
        done.append((conv, "".join(audit), digest.hexdigest()))
    yield _rows(done)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.string(), pa.string()), strict=True)],
                                      names=_REPAIRED.names)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit and digest are read off the operator's edits, in order; a conversation's digest is one stream."""
    given = read(spark, sf_dir, "conversations")
    edits, summary = conversation_repair.repair(damaged(given))
    repaired = (conversation_repair.in_order(edits.select("conv", "part", "chunk", "at", "k", "edit", "role", "text"))
                .mapInArrow(_digests, _REPAIRED).withColumnRenamed("conv", "_conv"))
    found = summary.join(repaired, F.col("conv").eqNullSafe(F.col("_conv"))).drop("_conv")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return (given.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
            .select("conv_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
                    F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")))


_EDITED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")
_AT_ONCE = 1 << 21                     # characters sketched at a time


def _edit_and_compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents and their successors in order: the edited text, all three fingerprints and their likeness."""
    def compared(rows: list[tuple]) -> pa.RecordBatch:
        edited = [t[:len(t) - len(t) // 2] + after[:len(t) // 2] for _, t, after, _ in rows]
        n, alone = len(rows), [i for i in range(len(rows)) if i + 1 == len(rows) or not rows[i + 1][3]]
        texts = [r[1] for r in rows] + edited + [rows[i][2] for i in alone]
        found = fingerprints.sketches(pa.array(texts, pa.large_string()))
        own, changed = found[:n], found[n:2 * n]
        after = dict(zip(alone, found[2 * n:], strict=True))
        cols = [[r[0] for r in rows], [len(r[1]) for r in rows], [sha256(t.encode()).hexdigest() for t in edited],
                [fingerprints.written(s) for s in own], [fingerprints.written(s) for s in changed],
                [fingerprints.alike(a, b) for a, b in zip(own, changed, strict=True)],
                [fingerprints.alike(a, after[i] if i in after else own[i + 1]) for i, a in enumerate(own)]]
        kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                          names=[f.split()[0] for f in _EDITED.split(", ")])

    rows, held = [], 0
    for row in successors.pairs(batches):
        rows.append(row)
        held += len(row[1]) + len(row[2])
        if held >= _AT_ONCE:
            yield compared(rows)
            rows, held = [], 0
    if rows:
        yield compared(rows)


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return successors.in_blocks(read(spark, sf_dir, "documents")).mapInArrow(_edit_and_compare, _EDITED)


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents; where 7 divides crc32(doc_id), n_chars was tampered with (a null id or n_chars stays)."""
    docs = read(spark, sf_dir, "documents")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    parts = lambda n: manifest.leaf_hash(F.col("doc_id"), F.col("source"), F.col("lang"), n, F.col("text"))
    own = parts(F.col("n_chars"))
    tampered = F.when(hit & F.col("n_chars").isNotNull(), parts(F.col("n_chars") + 1))
    leaves = manifest.leaves(docs, "lang", "doc_id", own, {"doc_id": F.col("doc_id"), "tampered": tampered})
    leaves = materialise(leaves, "manifest-ranked")
    proofs = manifest.prove(leaves, manifest.build(leaves))
    back = manifest.folded(F.coalesce(f"{ROW}.tampered", "leaf"), F.col("proof"))
    return (proofs.select(f"{ROW}.doc_id", "leaf", "subroot", "root",
                          F.sha2(F.array_join(manifest.siblings(F.col("proof")), ""), 256).alias("proof_sha256"),
                          back.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


_QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_tool_calls": (op1_tool_calls, oracles.TOOL_CALLS),
    "op2_licence_scan": (op2_licence_scan, oracles.LICENCE_SCAN),
    "op3_mixing": (op3_mixing, oracles.MIXING),
    "op4_sharding": (op4_sharding, None),
    "op5_exact_dedup": (op5_exact_dedup, oracles.EXACT_DEDUP),
    "op6_line_dedup": (op6_line_dedup, oracles.LINE_DEDUP),
    "op7_token_counts": (op7_token_counts, None),
    "op8_quality": (op8_quality, None),
    "op9_decontamination": (op9_decontamination, oracles.DECONTAMINATION),
    "op10_near_dedup": (op10_near_dedup, oracles.NEAR_DEDUP),
    "op11_conversation_repair": (op11_conversation_repair, None),
    "op12_fingerprints": (op12_fingerprints, None),
    "op13_manifest": (op13_manifest, oracles.MANIFEST),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for name, (fn, _) in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _QUERIES.items() if sql}
