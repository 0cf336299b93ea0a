"""The star's tables kept up to date drop by drop, without reading old rows again.

State lies under one folder and is committed by a numbered manifest
(:mod:`cadenza.sources.published`), so a drop counts wholly or not at all, and a
drop that is run again is known by its name and changes nothing.

* ``SeenRows``: digests of the distinct rows seen so far, in hash buckets, with
  a Bloom filter a bucket.  A row that its bucket's filter does not know is new
  without reading any digest; only buckets with a row that it may know are read.
* sums: per drop, the sum and number of popularities of the track rows that are
  new, and of the four features of the (genre, signature) tuples that are new.
  Fact and profile are these states added up.
* ``KeyIndex``: the sorted names in ranges, each with its own row numbers.  New
  names rewrite the ranges that they fall into; surrogate ids are row numbers
  plus the names of the ranges before, so they shift without any other write.
"""

from __future__ import annotations

import json
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza import schema as S
from cadenza.functions.columns import half_even_int
from cadenza.operators import clean as C
from cadenza.operators.star import artist_names
from cadenza.session import checkpoint, stage_scope
from cadenza.sources import published as P

BUCKETS = 64
#: a Bloom filter has 16 ** DIGITS bits; a digest sets HASHES of them
DIGITS = 5
HASHES = 4
RANGES = 16


def digest(cols: list[str]) -> Column:
    """128 bits of a row's values; null differs from any text."""
    return F.md5(F.concat_ws("\x1f", *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("~")) for c in cols]).cast("binary"))


def _bits(digests) -> np.ndarray:
    """The filter bits of hexadecimal digests, a row each."""
    raw = np.array([int(d, 16) for d in digests], dtype=object)
    return np.array([[(int(d) >> 4 * DIGITS * i) % 16 ** DIGITS for i in range(HASHES)] for d in raw], np.int64).reshape(-1, HASHES)


def _blooms(rows: DataFrame) -> DataFrame:
    """``(bucket, bloom)`` of the digests of each bucket."""
    def build(batches):
        # bits are or-ed bucket by bucket below, so a bucket may come in parts
        for pdf in batches:
            out = []
            for bucket, own in pdf.groupby("bucket"):
                bits = np.zeros(16 ** DIGITS, bool)
                bits[_bits(own["digest"]).ravel()] = True
                out.append((bucket, np.packbits(bits).tobytes()))
            yield pd.DataFrame(out, columns=["bucket", "bloom"])

    def unite(key, pdf):
        united = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in pdf["bloom"]])
        return pd.DataFrame({"bucket": [key[0]], "bloom": [united.tobytes()]})
    parts = rows.mapInPandas(build, "bucket int, bloom binary")
    return parts.groupBy("bucket").applyInPandas(unite, "bucket int, bloom binary")


class SeenRows:
    """Distinct rows of one kind, told apart by ``cols``."""

    def __init__(self, spark: SparkSession, base: str, state: dict, name: str, cols: list[str], buckets: int = BUCKETS):
        self.spark, self.base, self.name, self.cols, self.buckets = spark, base, name, cols, buckets
        self.state = state.setdefault(name, {"digests": [], "blooms": None})
        #: buckets whose digests the last drop had to read
        self.read_buckets: list[int] = []

    def fresh(self, rows: DataFrame, delta: str) -> DataFrame:
        """The rows (distinct in ``cols``) that no earlier drop had; they are told to the state."""
        bucket = F.pmod(F.xxhash64("digest"), F.lit(self.buckets)).cast("int")
        rows = checkpoint(rows.withColumn("digest", digest(self.cols)).withColumn("bucket", bucket), f"drop-{self.name}")
        new = rows
        if self.state["blooms"]:
            # at most a filter a bucket: buckets x 2 ** 17 bytes
            held = {r["bucket"]: np.frombuffer(r["bloom"], np.uint8) for r in
                    self.spark.read.parquet(f"{self.base}/{self.state['blooms']}").collect()}
            blooms = self.spark.sparkContext.broadcast(held)

            def maybe(batches):
                for pdf in batches:
                    out = np.zeros(len(pdf), bool)
                    for bucket, at in pdf.groupby("bucket").indices.items():
                        if (bloom := blooms.value.get(bucket)) is not None:
                            bits = _bits(pdf["digest"].to_numpy()[at])
                            out[at] = (bloom[bits >> 3] >> (7 - (bits & 7)) & 1).all(axis=1)
                    yield pdf[["digest", "bucket"]][out]
            known = checkpoint(rows.select("digest", "bucket").mapInPandas(maybe, "digest string, bucket int"), f"known-{self.name}")
            self.read_buckets = sorted(r["bucket"] for r in known.select("bucket").distinct().collect())
            if self.read_buckets:
                old = self.seen().where(F.col("bucket").isin(self.read_buckets)).select("digest")
                again = known.select("digest").join(old, "digest", "left_semi").withColumnRenamed("digest", "again")
                new = checkpoint(rows.join(again, F.col("digest") == F.col("again"), "left_anti"), f"fresh-{self.name}")
        told = new.select("digest", "bucket")
        told.repartition("bucket").write.partitionBy("bucket").parquet(f"{self.base}/{delta}/{self.name}-digests")
        blooms = _blooms(told)
        if self.state["blooms"]:
            blooms = _united(blooms.unionByName(self.spark.read.parquet(f"{self.base}/{self.state['blooms']}")))
        blooms.write.parquet(f"{self.base}/{delta}/{self.name}-blooms")
        self.state["digests"].append(f"{delta}/{self.name}-digests")
        self.state["blooms"] = f"{delta}/{self.name}-blooms"
        return new.drop("digest", "bucket")

    def seen(self) -> DataFrame:
        """``(digest, bucket)`` of all rows seen, in folders by bucket."""
        frames = [self.spark.read.schema("digest string, bucket int").parquet(f"{self.base}/{p}") for p in self.state["digests"]]
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out


def _united(blooms: DataFrame) -> DataFrame:
    def unite(key, pdf):
        united = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in pdf["bloom"]])
        return pd.DataFrame({"bucket": [key[0]], "bloom": [united.tobytes()]})
    return blooms.groupBy("bucket").applyInPandas(unite, "bucket int, bloom binary")


class KeyIndex:
    """Sorted distinct names in ranges with their numbers; null is no name (id 0)."""

    def __init__(self, spark: SparkSession, base: str, state: dict, name: str, ranges: int = RANGES):
        self.spark, self.base, self.name, self.ranges = spark, base, name, ranges
        self.state = state.setdefault(f"{name}-keys", {"bounds": [], "ranges": {}, "null": False})
        #: ranges that the last drop wrote
        self.written: list[int] = []

    def _range_of(self, key: Column) -> Column:
        """The last range that begins at or before ``key`` (the first one, if none does)."""
        bounds = F.array(*[F.lit(b) for b in self.state["bounds"]])
        return F.greatest(F.lit(0), F.size(F.filter(bounds, lambda b: b <= key)) - 1)

    def add(self, names: DataFrame, delta: str) -> None:
        """Merge ``names (key)`` into the ranges."""
        names = checkpoint(names.distinct(), f"names-{self.name}")
        self.state["null"] = self.state["null"] or not names.where("key IS NULL").isEmpty()
        names = names.where("key IS NOT NULL")
        if not self.state["bounds"]:
            # a first drop sets the bounds: one row a range
            dealt = checkpoint(names.repartitionByRange(self.ranges, "key").select("key", F.spark_partition_id().alias("p")), f"ranges-{self.name}")
            first = [r["key"] for r in dealt.groupBy("p").agg(F.min("key").alias("key")).orderBy("key").collect()]
            if not first:
                return
            self.state["bounds"] = first
        names = names.withColumn("range", self._range_of(F.col("key")))
        old = self.keys()
        if old is not None:
            touched = [r["range"] for r in names.select("range").distinct().collect()]
            old = old.where(F.col("range").isin(touched)).select("key", "range")
            new = checkpoint(names.join(old.select(F.col("key").alias("has")), F.col("key") == F.col("has"), "left_anti"), f"new-{self.name}")
            grown = [r["range"] for r in new.select("range").distinct().collect()]
            names = new.unionByName(old.where(F.col("range").isin(grown)))
        row = F.row_number().over(Window.partitionBy("range").orderBy("key"))
        path = f"{delta}/{self.name}-keys"
        rows = checkpoint(names.withColumn("row", row), f"rows-{self.name}")
        rows.repartition("range").write.partitionBy("range").parquet(f"{self.base}/{path}")
        counts = rows.groupBy("range").count().collect()
        self.written = sorted(r["range"] for r in counts)
        for r in counts:
            self.state["ranges"][str(r["range"])] = {"path": path, "n": r["count"]}

    def keys(self) -> DataFrame | None:
        """``(key, row, range)`` as stored."""
        held, out = self.state["ranges"], None
        by_path: dict[str, list[int]] = {}
        for r, x in held.items():
            by_path.setdefault(x["path"], []).append(int(r))
        for path, own in by_path.items():
            part = self.spark.read.schema("key string, row int, range int").parquet(f"{self.base}/{path}").where(F.col("range").isin(own))
            out = part if out is None else out.unionByName(part)
        return out

    def ids(self, id_col: str, key_col: str) -> DataFrame:
        """The dimension: dense ids from 1 in sort order, 0 for null."""
        null = self.spark.range(1 if self.state["null"] else 0).select(F.lit(0).cast("long").alias(id_col), F.lit(None).cast("string").alias(key_col))
        keys = self.keys()
        if keys is None:
            return null
        before, shift = 0, F.lit(0).cast("long")
        for r in sorted(self.state["ranges"], key=int):
            shift = F.when(F.col("range") == int(r), F.lit(before).cast("long")).otherwise(shift)
            before += self.state["ranges"][r]["n"]
        return keys.select((shift + F.col("row")).alias(id_col), F.col("key").alias(key_col)).unionByName(null)


class IncrementalStar:
    """Cleaned rows, fact, genre profile and name dimensions, kept by drops."""

    def __init__(self, spark: SparkSession, base: str, buckets: int = BUCKETS, ranges: int = RANGES):
        self.spark, self.base = spark, base
        known = P.versions(spark, base)
        self.version = known[-1] if known else 0
        self.state = P.manifest(spark, base, self.version) if known else {"drops": [], "sums": {}, "clean": []}
        self._state(json.loads(json.dumps(self.state)), buckets, ranges)

    def _state(self, state: dict, buckets: int, ranges: int) -> None:
        self.state, self._sizes = state, (buckets, ranges)
        spark, base = self.spark, self.base
        self.rows = SeenRows(spark, base, state, "rows", S.DATA_COLS, buckets)
        self.tracks = SeenRows(spark, base, state, "tracks", S.TRACK_COLS, buckets)
        self.tuples = SeenRows(spark, base, state, "tuples", S.GENRE_FEATURE_COLS, buckets)
        self.artists, self.albums = KeyIndex(spark, base, state, "artists", ranges), KeyIndex(spark, base, state, "albums", ranges)

    def apply(self, drop: DataFrame, name: str) -> bool:
        """Take in a drop of raw rows; False if it was taken in before."""
        if name in self.state["drops"]:
            return False
        before, delta = json.loads(json.dumps(self.state)), f"drops/{uuid.uuid4().hex}"
        try:
            with stage_scope(self.spark):
                self._take(drop, delta)
            self.state["drops"].append(name)
            self.state["version"] = self.version + 1
            P._put(self.spark, f"{self.base}/manifests/{self.version + 1:012d}.json", json.dumps(self.state))
        except BaseException:
            P.delete_paths(self.spark, [f"{self.base}/{delta}"])
            self._state(before, *self._sizes)
            raise
        self.version += 1
        return True

    def _take(self, drop: DataFrame, delta: str) -> None:
        rows = C.dedup_rows(C.filter_not_null(drop, "track_name"), S.DATA_COLS)
        new = C.filter_ne_nullsafe(self.rows.fresh(rows, delta), "time_signature", S.DROP_TIME_SIGNATURE)
        clean = checkpoint(C.replace_values(new, "time_signature", S.REPLACE_TIME_SIGNATURE), "drop-clean")
        self._write(clean, delta, "clean")
        tracks = self.tracks.fresh(C.track_rows(clean), delta)
        self._write(tracks.where("track_id IS NOT NULL").groupBy("track_id").agg(
            F.sum("popularity").alias("total"), F.count("popularity").alias("n")), delta, "popularity")
        tuples = self.tuples.fresh(clean.select(*S.GENRE_FEATURE_COLS).distinct(), delta)
        sums = [x for c in S.SIMILARITY_COLS for x in (F.sum(c).alias(c), F.count(c).alias(f"n_{c}"))]
        self._write(tuples.where("track_genre IS NOT NULL AND time_signature IS NOT NULL")
                    .groupBy("track_genre", "time_signature").agg(*sums), delta, "features")
        self.artists.add(artist_names(tracks).select(F.col("artist_name").alias("key")), delta)
        self.albums.add(tracks.select(F.col("album_name").alias("key")), delta)

    def _write(self, df: DataFrame, delta: str, name: str) -> None:
        df.write.parquet(f"{self.base}/{delta}/{name}")
        self.state["sums"].setdefault(name, []).append(f"{delta}/{name}")

    def _sums(self, name: str) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.base}/{p}" for p in self.state["sums"][name]])

    def clean(self) -> DataFrame:
        return self._sums("clean")

    def fact_track_popularity(self) -> DataFrame:
        mean = F.sum("total") / F.sum("n")
        return self._sums("popularity").groupBy("track_id").agg(half_even_int(F.when(F.sum("n") > 0, mean)).alias("popularity"))

    def genre_profile(self) -> DataFrame:
        means = [F.when(F.sum(f"n_{c}") > 0, F.sum(c) / F.sum(f"n_{c}")).alias(c) for c in S.SIMILARITY_COLS]
        return self._sums("features").groupBy("track_genre", "time_signature").agg(*means)

    def dim_artists(self) -> DataFrame:
        return self.artists.ids("artist_id", "artist_name")

    def dim_albums(self) -> DataFrame:
        return self.albums.ids("album_id", "album_name")
