"""Line dedup with levelled sorted runs of line hashes, in DataFrame functions only.

A run is a table of (``h``, ``docs``): the 128-bit hash of a line's key and the number of documents it was found
in, each hash once, bucketed and sorted by it, so that runs are joined and merged bucket by bucket without
another shuffle. A batch of documents counts its own keys, merge-anti-joins the runs' *settled* keys (those found
in enough documents already: further counts change nothing) and adds the rest as a run of level 0. When a level
holds ``fanout`` runs they are compacted into one run of the next. After the last batch all runs are merged; the
keys found in enough documents lose all their lines.

Where the work is skewed: counts are summed per task before any shuffle. Keys found often enough to be hot are
known by a bound: a key with more than one in ``HOT_SHARE`` of all lines has more than one in ``HOT_SHARE`` of
some batch's, so there are at most ``batches * HOT_SHARE`` of them. Only those are looked up by broadcast; all
others meet their lines in a merge join, where none of them is hot. Texts are shuffled once, by their own row's
key, to lose their lines.

Two keys with the same 128-bit hash would count as one; among 10^13 different lines that has a chance of 10^-13.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, scratch_path, spare_names

#: What is stripped from both ends of a line: fixed values, the characters 0x20 and 0x09-0x0D.
BLANK = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Batches that a whole table is added in, and runs of a level before they are compacted.
BATCHES, FANOUT = 6, 3
#: A key with over one in so many of a batch's lines may be hot; there are at most so many a batch.
HOT_SHARE = 10_000


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else; Spark's own ``lower`` does that for a text of single-byte characters."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def line_keys(text: Column, min_chars: int) -> Column:
    """One entry a line of ``text``: the 16-byte hash of its key, null if the key is shorter than ``min_chars``."""
    stripped = F.transform(F.split(lower_ascii(text), "\n", -1), lambda line: F.btrim(line, F.lit(BLANK)))
    return F.transform(stripped, lambda key: F.when(F.length(key) >= max(min_chars, 1), F.unhex(F.md5(key))))


def _no_hashes(spark: SparkSession) -> DataFrame:
    return spark.range(0).select(F.lit(None).cast("binary").alias("h"))


class LineRuns:
    """The levelled runs below ``path`` (a folder that all executors share; a scratch folder if none is given).

    ``levels`` holds the paths of the runs, oldest level last; an index that was kept can be opened again with it.
    """

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = FANOUT, path: str | None = None,
                 levels: list[list[str]] | None = None, buckets: int | None = None):
        self.spark, self.min_docs, self.fanout = spark, min_docs, max(2, fanout)
        self.path = path or scratch_path(spark, "lineruns")
        self.levels = [list(level) for level in levels or []]
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def _write(self, counts: DataFrame) -> str:
        """A run of ``counts`` (h, docs): bucketed by the hash and sorted by it in each bucket."""
        path = f"{self.path}/run-{uuid.uuid4().hex[:12]}"
        name = f"tapline_run_{uuid.uuid4().hex}"
        spread = counts.repartition(self.buckets, "h")
        spread.write.format("parquet").bucketBy(self.buckets, "h").sortBy("h").option("path", path).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")          # the catalogue's entry only: the run's files stay
        return path

    def _read(self, path: str) -> DataFrame:
        name = f"tapline_run_{uuid.uuid4().hex}"
        self.spark.sql(f"CREATE TABLE {name} (h BINARY, docs BIGINT) USING parquet "
                       f"CLUSTERED BY (h) SORTED BY (h) INTO {self.buckets} BUCKETS LOCATION '{path}'")
        run = self.spark.table(name).select("h", "docs")
        run.schema                                    # analysed now, so the entry may go
        self.spark.sql(f"DROP TABLE {name}")
        return run

    def runs(self) -> list[DataFrame]:
        return [self._read(path) for level in self.levels for path in level]

    def _merged(self, runs: list[DataFrame]) -> DataFrame:
        """All runs' hashes, each once, with the sum of its documents: sorted buckets are merged pair by pair."""

        def merge(one: DataFrame, other: DataFrame) -> DataFrame:
            other = other.withColumnRenamed("docs", "more").hint("merge")
            both = F.coalesce(F.col("docs"), F.lit(0)) + F.coalesce(F.col("more"), F.lit(0))
            return one.join(other, "h", "full").select("h", both.alias("docs"))

        return reduce(merge, runs)

    def add(self, counts: DataFrame) -> None:
        """Add a batch's (h, docs), without the keys that the runs have settled, and compact full levels."""
        for run in self.runs():
            settled = run.filter(F.col("docs") >= self.min_docs).select("h")
            counts = counts.join(settled.hint("merge"), "h", "left_anti")
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(self._write(counts))
        for k in range(len(self.levels)):
            if len(self.levels[k]) >= self.fanout:
                compact = self._write(self._merged([self._read(p) for p in self.levels[k]]))
                self.levels[k] = []
                if k + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[k + 1].append(compact)

    def settled(self) -> DataFrame:
        """The hashes found in at least ``min_docs`` documents of all batches."""
        runs = self.runs()
        if not runs:
            return _no_hashes(self.spark)
        return self._merged(runs).filter(F.col("docs") >= self.min_docs).select("h")


def repeated_positions(rows: DataFrame, min_docs: int, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """(``r``, ``gone``): rows that lose lines and which, from 0, for ``rows`` of (r, keys)."""
    spark = rows.sparkSession
    keys = cut(rows, "linekeys")
    batch = F.pmod(F.xxhash64("r"), F.lit(batches)).cast("int")
    own = keys.select(batch.alias("batch"), F.explode(F.array_distinct(F.array_compact("keys"))).alias("h"))
    counts = cut(own.groupBy("batch", "h").agg(F.count("*").alias("docs")), "linecounts")
    lines = {r["batch"]: r["n"] for r in counts.groupBy("batch").agg(F.sum("docs").alias("n")).collect()}
    index, often = LineRuns(spark, min_docs, fanout), []
    for b in sorted(lines):
        part = counts.filter(F.col("batch") == b).select("h", "docs")
        index.add(part)
        often.append(part.filter(F.col("docs") * HOT_SHARE > lines[b]).select("h"))
    settled = index.settled()
    places = keys.select("r", F.posexplode("keys").alias("pos", "h")).filter("h is not null")
    hot = _no_hashes(spark)
    if often:
        hot = cut(reduce(DataFrame.unionByName, often).distinct().join(settled, "h", "left_semi"), "hotlines")
    marked = places.join(F.broadcast(hot.withColumn("hot", F.lit(True))), "h", "left")
    rest = marked.filter("hot is null").join(settled.hint("merge"), "h", "left_semi")
    gone = marked.filter("hot").select("r", "pos").unionByName(rest.select("r", "pos"))
    return gone.groupBy("r").agg(F.collect_set("pos").alias("gone"))


def drop_repeated_lines(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_docs: int = 10,
                        min_chars: int = 1, batches: int = BATCHES) -> DataFrame:
    """``df`` with ``kept`` (the text without repeated lines), ``n_lines`` and ``n_dropped``, all rows.

    Lines end at ``\\n``; a null or empty text is one empty line. A line's key is the line without blanks at its
    ends, A-Z in lower case. Keys of at least ``min_chars`` code points that are found in at least ``min_docs``
    documents lose all their lines in every document; an empty key is never dropped. Each row is a document,
    whatever its id: rows with one id, or none, count one by one, and equal rows get equal results. A repeated
    line counts once a document. An empty table gives no rows. Columns of ``df`` with the new names are replaced.
    """
    base = df.drop("kept", "n_lines", "n_dropped")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    own = F.col(f"`{id_col}`")
    # equal rows may share a key: they have the same lines
    key = F.struct(F.xxhash64(own, text).alias("a"), F.xxhash64(F.lit(1), text, own).alias("b"))
    gone = repeated_positions(df.select(key.alias("r"), line_keys(text, min_chars).alias("keys")), min_docs, batches)
    a, b, which, lines = spare_names(base, "gone_a", "gone_b", "gone", "lines")
    gone = gone.select(F.col("r.a").alias(a), F.col("r.b").alias(b), F.col("gone").alias(which))
    joined = base.join(gone, (key["a"] == F.col(a)) & (key["b"] == F.col(b)), "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), which)
    cleaned = F.when(F.col(which).isNull(), text).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(F.col(lines), i)), "\n"))
    return joined.withColumn(lines, F.split(text, "\n", -1)).withColumns({
        "kept": cleaned, "n_lines": F.size(lines).cast("long"),
        "n_dropped": F.coalesce(F.size(which), F.lit(0)).cast("long")}).drop(lines, which, a, b)
