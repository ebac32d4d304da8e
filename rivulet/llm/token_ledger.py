"""Token counts as delta-maintained rollups.

A ledger is three append-only tables under one shared folder, one folder per
batch: ``entries`` (signed rows per document), ``rollup`` (the batch's signed
totals by source, language and tokenizer) and ``commits`` (a marker, written
last). Totals are the sum of the committed rollups, so their cost follows the
number of groups, not of documents. A batch id commits once: a replay of a
committed batch does nothing, a batch that died before its marker is written
again over its own folders and was never visible.

Changes are rows (op, doc_id, source, lang, text). ``insert`` and ``revise``
replace whatever the ledger holds for that doc_id under that tokenizer;
``delete`` takes it back. Only documents named in a batch are looked up. A batch
has no order of rows: its deletions and replacements apply to what earlier
batches left, then its inserted and revised rows count, also those whose id the
same batch deletes. An ``op`` that is none of the three raises.

Defined cases: a null text has no tokens; null source, lang or id are groups
of their own; rows repeated within one batch count as often as they stand
there; an empty batch commits empty totals; extra columns are ignored; texts
are encoded whole, special-token strings as ordinary text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOKENIZER_DIR = "/opt/tokenizers"
OPS = ("insert", "revise", "delete")
_GROUP = ["source", "lang", "tokenizer"]
_PIECE = 1 << 20  # characters encoded at once; a longer text is cut before a space that follows a letter
_ENCODERS: dict = {}


def encoder(path: str):
    """tiktoken encoding of a rank file, one per worker."""
    if path not in _ENCODERS:
        import tiktoken

        # fixed value: the published pre-tokenizer pattern of the byte-level BPE vocabularies
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        with open(path, "rb") as f:
            ranks = {base64.b64decode(t): int(n) for t, n in map(bytes.split, f)}
        _ENCODERS[path] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[path]


def count_tokens(text: str | None, enc) -> int:
    """Tokens of a whole text. Cuts lie between a letter and one space before a letter, where the pattern also cuts."""
    if not text:
        return 0
    n, i = 0, 0
    while len(text) - i > _PIECE:
        j = i + _PIECE
        while j < len(text) and not (text[j] == " " and text[j - 1].isalpha() and text[j + 1:j + 2].isalpha()):
            j += 1
        n += len(enc.encode_ordinary(text[i:j]))
        i = j
    return n + len(enc.encode_ordinary(text[i:]))


def _counted(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    enc = encoder(path)
    for b in batches:
        n = pa.array([count_tokens(t, enc) for t in b.column("text").to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays([*b.drop_columns(["text"]).columns, n], names=[*(c for c in b.schema.names if c != "text"), "tokens"])


class TokenLedger:
    """Additive token totals by source, language and tokenizer version, kept up by signed batches."""

    def __init__(self, spark: SparkSession, root: str, tokenizers: dict[str, str]):
        """``tokenizers``: version name -> rank file, readable on every executor."""
        if not tokenizers:
            raise ValueError("a ledger needs a tokenizer")
        self.spark, self.root, self.tokenizers = spark, root.rstrip("/"), dict(tokenizers)

    def _batches(self) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/commits")  # noqa: SLF001 - Hadoop FileSystem API
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())  # noqa: SLF001
        if not fs.exists(path):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(path) if fs.exists(
            self.spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")))  # noqa: SLF001

    def committed(self, batch_id: int) -> bool:
        return f"batch={batch_id}" in self._batches()

    def _read(self, kind: str, schema: str) -> DataFrame:
        paths = [f"{self.root}/{kind}/{b}" for b in self._batches()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def entries(self, key_type: str) -> DataFrame:
        return self._read("entries", f"doc_id {key_type}, source string, lang string, tokenizer string, docs long, tokens long")

    def apply(self, batch_id: int, changes: DataFrame) -> bool:
        """Commit one batch of (op, doc_id, source, lang, text); False if it was committed before."""
        if self.committed(batch_id):
            return False
        key_type = dict(changes.dtypes)["doc_id"]
        known = F.when(F.col("op").isin(*OPS), F.col("op")).otherwise(F.raise_error(F.concat(F.lit("unknown op "), F.coalesce("op", F.lit("null")))))
        changes = changes.select(known.alias("op"), "doc_id", "source", "lang", "text")
        added = None
        for version, path in self.tokenizers.items():
            rows = changes.where(F.col("op").isin("insert", "revise")).select(
                "doc_id", "source", "lang", F.lit(version).alias("tokenizer"), F.lit(1).cast("long").alias("docs"), "text")
            counted = rows.mapInArrow(lambda it, p=path: _counted(it, p),
                                      f"doc_id {key_type}, source string, lang string, tokenizer string, docs long, tokens long")
            added = counted if added is None else added.unionByName(counted)
        held = self.entries(key_type)
        touched = changes.where(F.col("op").isin(*OPS)).select(F.col("doc_id").alias("_id")).distinct()
        live = (held.where(F.col("tokenizer").isin(list(self.tokenizers)))
                .join(touched, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
                .groupBy("doc_id", *_GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0"))
        back = live.select("doc_id", *_GROUP, (-F.col("docs")).alias("docs"), (-F.col("tokens")).alias("tokens"))
        at = f"batch={batch_id}"
        added.unionByName(back).write.mode("overwrite").parquet(f"{self.root}/entries/{at}")
        signed = self.spark.read.schema(held.schema).parquet(f"{self.root}/entries/{at}")
        delta = signed.groupBy(*_GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        delta.write.mode("overwrite").parquet(f"{self.root}/rollup/{at}")
        self.spark.range(1).write.mode("overwrite").parquet(f"{self.root}/commits/{at}")
        return True

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens of all committed batches; emptied groups vanish."""
        rollup = self._read("rollup", "source string, lang string, tokenizer string, docs long, tokens long")
        return (rollup.groupBy(*_GROUP).agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens"))
                .where("n_docs <> 0"))
