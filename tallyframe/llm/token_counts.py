"""Token counts by source, language and tokenizer version, kept up by signed deltas.

The state is a folder of two append-only tables with one folder for each committed batch:
- ``ledger``: a signed row for each change of a document's count under a tokenizer version, and
- ``rollup``: each batch's changes summed over (source, lang, tokenizer).
Totals are sums over the rollup, so reading them costs the number of groups and batches, not of documents. An insert adds
(+1, +n); a delete subtracts what the ledger holds for the document; a revision is both. A batch is written to a temporary
folder and renamed when it is complete, ledger first: committing a batch id again changes nothing, and a batch that died
half-way is written anew.

Groups are summed map-side, so a source with a third of all rows sends one row a task. The ledger is joined to a batch's
deletes and revisions by a hash of the document, never collected.

Defined results: null sources and languages are groups of their own; null texts count 0 tokens; a null doc_id is a document
like others; an insert of a document that is present is a revision, a delete of an absent one nothing. A batch can name a
document and tokenizer several times: of its rows one counts, a delete last, else the one with the most tokens, then the
greatest source and language. An empty batch is committed and changes nothing. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GROUP = ("source", "lang", "tokenizer")


def words_v1(text: Column) -> Column:
    """Stretches between white space."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long")


def words_v2(text: Column) -> Column:
    """Runs of letters and digits, and every other visible ASCII character by itself."""
    text = F.coalesce(text, F.lit(""))
    marks = F.regexp_replace(text, r"[^!-/:-@\[-`{-~]", "")
    runs = F.array_remove(F.split(text, r"[\x00-/:-@\[-`{-\x7F]+"), "")
    return (F.size(runs) + F.length(marks)).cast("long")


#: Tokenizer versions by name.
TOKENIZERS: Mapping[str, object] = {"words-1": words_v1, "words-2": words_v2}


def count(docs: DataFrame, *tokenizers: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, source, lang, tokenizer, n_tokens of each document under each tokenizer; texts are read once."""
    counts = F.array(*[F.struct(F.lit(t).alias("tokenizer"), TOKENIZERS[t](F.col(text)).alias("n_tokens")) for t in tokenizers])
    return docs.select(F.col(key).alias("doc_id"), "source", "lang", F.inline(counts))


class TokenRollup:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def _publish(self, df: DataFrame, table: str, batch: str) -> None:
        final = f"{self.path}/{table}/batch={batch}"
        if self._exists(final):
            return
        staged = f"{self.path}/_staged/{table}-{batch}"
        df.write.mode("overwrite").parquet(staged)
        fs, p = self._fs(final)
        fs.mkdirs(p.getParent())
        if not fs.rename(self._fs(staged)[1], p) and not self._exists(final):
            raise OSError(f"batch {batch} could not be published to {final}")

    def _read(self, table: str, schema: str, without: str | None = None) -> DataFrame:
        if not self._exists(f"{self.path}/{table}"):
            return self.spark.createDataFrame([], f"{schema}, batch string")
        rows = self.spark.read.schema(f"{schema}, batch string").option("basePath", f"{self.path}/{table}").parquet(f"{self.path}/{table}")
        return rows.where(F.col("batch") != without) if without is not None else rows

    def ledger(self, without: str | None = None) -> DataFrame:
        return self._read("ledger", "doc_id long, source string, lang string, tokenizer string, docs long, tokens long", without)

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Applies ``changes``: op ('insert', 'revise' or 'delete'), doc_id, source, lang, tokenizer, n_tokens.

        A delete needs no source, lang or count. False if the batch had been committed.
        """
        if self._exists(f"{self.path}/rollup/batch={batch}"):
            return False
        if not self._exists(f"{self.path}/ledger/batch={batch}"):
            row = F.struct((F.col("op") != "delete").alias("kept"), "n_tokens", "source", "lang", "op")
            changes = changes.groupBy("doc_id", "tokenizer").agg(F.max(row).alias("row")).select("row.op", "doc_id", "row.source", "row.lang", "tokenizer", "row.n_tokens")
            done = changes.where("op <> 'delete'").select("doc_id", *GROUP, F.lit(1).cast("long").alias("docs"), F.col("n_tokens").alias("tokens"))
            if not self._exists(f"{self.path}/ledger"):
                self._publish(done, "ledger", batch)  # the first batch undoes nothing
                return self._roll(batch)
            # Only the ledger rows of the batch's documents are added up.
            named = changes.select(F.col("doc_id").alias("named_id"), F.col("tokenizer").alias("named_tokenizer"))
            held = self.ledger(without=batch).join(named, F.col("doc_id").eqNullSafe(F.col("named_id")) & (F.col("tokenizer") == F.col("named_tokenizer")), "left_semi")
            held = held.groupBy("doc_id", *GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0 OR tokens <> 0")
            undone = held.select("doc_id", *GROUP, (-F.col("docs")).alias("docs"), (-F.col("tokens")).alias("tokens"))
            self._publish(undone.unionAll(done), "ledger", batch)
        return self._roll(batch)

    def _roll(self, batch: str) -> bool:
        rows = self.ledger().where(F.col("batch") == batch)
        self._publish(rows.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")), "rollup", batch)
        return True

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens of the groups that hold documents."""
        rows = self._read("rollup", "source string, lang string, tokenizer string, docs long, tokens long")
        out = rows.groupBy(*GROUP).agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens"))
        return out.where("n_docs <> 0 OR n_tokens <> 0")
