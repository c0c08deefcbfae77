"""Curated rows kept up to date batch by batch, with the result of a run over all history.

Rules that look at other rows need state. Uniqueness keeps, beside the newest candidate of every key, one row
per unique value that names its winner; a batch is judged against the values it touches, and the candidates
are searched only for values whose winner has left. References park rejected rows and join them with
the keys of new parents, so that neither children nor parents are read again.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from camadas.contracts import Entity
from camadas.operators import quality
from camadas.plans.silver import INGESTED_AT, NEWEST, SOURCE_FILE, newest_versions
from camadas.session import staged
from camadas.sources.state import Journal, KeyedState, offered


def _curated_type(entity: Entity) -> list[T.StructField]:
    return [T.StructField(f.name, T._parse_datatype_string(f.type)) for f in entity.fields]


class UniqueSilver:
    """One curated table under at most one uniqueness rule, as two keyed states.

    ``candidates`` has the newest version of every key, whether it passes the field rules (``_ok``), its unique
    value where the rule applies to it (``_value``), and whether another key won that value (``_lost``).
    ``values`` has the winner of every value, its newest holder as ``flag_duplicates`` orders them. The
    curated table is what is ``_ok`` and not ``_lost``.

    What a batch changes in both states is written beside them first. A run that dies while the states are
    being changed is completed by the next one, which puts the same rows in place again.
    """

    def __init__(self, spark: SparkSession, path: str, entity: Entity, buckets: int = 64):
        if len(entity.unique) > 1:
            raise ValueError(f"{entity.name}: one uniqueness rule at most")
        self.spark, self.entity = spark, entity
        lineage = [T.StructField(SOURCE_FILE, T.StringType()), T.StructField(INGESTED_AT, T.TimestampType())]
        judged = [T.StructField(n, t) for n, t in (("_key", T.StringType()), ("_tie", T.LongType()), ("_ok", T.BooleanType()),
                                                   ("_value", T.StringType()), ("_lost", T.BooleanType()))]
        rows = T.StructType([*_curated_type(entity), *lineage, *judged])
        self.candidates = KeyedState(spark, f"{path}/candidates", "_key", rows, buckets)
        rank = T.StructType([rows[c] for c in (*NEWEST, entity.key, "_key")])
        self.values = KeyedState(spark, f"{path}/values", "_value", T.StructType([
            T.StructField("_value", T.StringType()), T.StructField("_winner", rank)]), buckets)
        self.journal = Journal(spark, f"{path}/pending", self._put)

    def read(self) -> DataFrame:
        return self.candidates.read().filter("_ok and not _lost").select(*self.entity.columns)

    def _value(self) -> Column:
        if not self.entity.unique:
            return F.lit(None).cast("string")
        rule = self.entity.unique[0]
        inside = F.col("_ok")
        if rule.when_field is not None:
            inside = inside & F.coalesce(F.col(rule.when_field) == F.lit(rule.when_value), F.lit(False))
        return F.when(inside, F.to_json(F.struct(*rule.fields)))

    def _rank(self) -> Column:
        return F.struct(*NEWEST, self.entity.key, "_key")

    def add(self, raw: DataFrame) -> dict:
        """Bring the table up to date with a batch of raw lines; a repeated batch changes nothing."""
        self.journal.complete()
        newest = newest_versions(raw, self.entity)
        judged = newest.withColumn("_ok", quality.is_valid(self.entity)).withColumn("_value", self._value())
        with staged(judged.withColumn("_lost", F.lit(False)).select(*self.candidates.columns), "unique-batch") as batch:
            old = self.candidates.matching(batch, batch.count(), *NEWEST, "_tie", "_value")
            was = old.select("_key", F.struct(*NEWEST, "_tie").alias("_old"), F.col("_value").alias("_was"))
            newer = F.col("_old").isNull() | (F.struct(*NEWEST, "_tie") > F.col("_old"))
            changed = batch.join(was, "_key", "left").filter(newer).drop("_old")
            with staged(changed, "unique-changed") as changed:
                return self._settle(changed)

    def _settle(self, changed: DataFrame) -> dict:
        n = changed.count()
        if not n:
            return {"changed": 0, "searched": 0, "flipped": 0}
        enter = changed.filter("_value is not null").groupBy("_value").agg(F.max(self._rank()).alias("_best"))
        leave = changed.filter("_was is not null").select(F.col("_was").alias("_value"), F.col("_key").alias("_left"))
        named = enter.select("_value").unionByName(leave.select("_value")).distinct()
        with staged(named, "unique-values") as named:
            known = self.values.matching(named, named.count(), "_winner")
            gone = leave.join(known.select("_value", F.col("_winner._key").alias("_left")), ["_value", "_left"], "left_semi")
            values = (
                named.join(known, "_value", "left").join(enter, "_value", "left")
                .join(gone.select("_value", F.lit(True).alias("_gone")), "_value", "left").na.fill(False, ["_gone"])
            )
            # A winner that left is followed without a search only by an entrant that beats it.
            beaten = F.coalesce(F.col("_best") >= F.col("_winner"), F.lit(False))
            following = F.when(F.col("_winner").isNull() | beaten, F.col("_best")).when(~F.col("_gone"), F.col("_winner"))
            values = values.withColumns({"_search": F.col("_gone") & ~beaten, "_next": following})
            with staged(values, "unique-next") as values:
                return self._decide(changed, n, values)

    def _decide(self, changed: DataFrame, n: int, values: DataFrame) -> dict:
        searched = values.filter("_search").select("_value")
        n_searched = searched.count()
        if n_searched:
            stayed = self.candidates.read().filter("_value is not null").select("_value", *NEWEST, self.entity.key, "_key")
            stayed = stayed.join(offered(searched, n_searched), "_value").join(offered(changed.select("_key"), n), "_key", "left_anti")
            entrants = changed.join(offered(searched, n_searched), "_value").select(*stayed.columns)
            found = stayed.unionByName(entrants).groupBy("_value").agg(F.max(self._rank()).alias("_found"))
            values = values.join(found, "_value", "left").withColumn("_next", F.coalesce("_next", "_found")).drop("_found")
        with staged(values, "unique-winners") as values:
            deposed = values.filter("_winner is not null and not _gone and _winner._key <> _next._key").select(
                F.col("_winner._key").alias("_key"), F.lit(True).alias("_now"))
            crowned = values.filter("_next is not null").select(F.col("_next._key").alias("_key"), F.lit(False).alias("_now"))
            flips = deposed.unionByName(crowned).join(changed.select("_key"), "_key", "left_anti")
            with staged(flips, "unique-flips") as flips:
                old = self.candidates.matching(flips, flips.count(), *self.candidates.columns).join(flips, "_key")
                flipped = old.filter(F.col("_lost") != F.col("_now")).withColumn("_lost", F.col("_now"))
                n_flipped = flipped.count()
                winners = values.select("_value", F.col("_next._key").alias("_won"))
                fresh = changed.join(winners, "_value", "left").withColumn(
                    "_lost", F.coalesce(F.col("_key") != F.col("_won"), F.lit(False)))
                rows = fresh.select(*self.candidates.columns).unionByName(flipped.select(*self.candidates.columns))
                index = values.select("_value", F.col("_next").alias("_winner"))
                self.journal.put(rows=rows, index=index)
                return {"changed": n, "searched": n_searched, "flipped": n_flipped}

    def _put(self, frames: dict[str, DataFrame]) -> None:
        index = frames["index"]
        self.values.change(index.filter("_winner is not null"), index.filter("_winner is null").select("_value"))
        self.candidates.change(frames["rows"])


class ParkedReferences:
    """Curated children and the parked ones, whose references do not all resolve yet.

    A parked row carries the references it misses. Parents that arrive later are joined with the parked rows
    only; a row that misses nothing more moves to the curated state.
    """

    def __init__(self, spark: SparkSession, path: str, entity: Entity, buckets: int = 64):
        self.entity = entity
        fields = _curated_type(entity)
        self.curated = KeyedState(spark, f"{path}/curated", entity.key, T.StructType(fields), buckets)
        missing = T.StructField("_missing", T.ArrayType(T.StringType()))
        self.parked = KeyedState(spark, f"{path}/parked", entity.key, T.StructType([*fields, missing]), buckets)

    def _judge(self, rows: DataFrame, parents: Mapping[str, DataFrame]) -> DataFrame:
        """``_missing``: the references, of those whose parents are given, that do not resolve."""
        flags = []
        for i, ref in enumerate(self.entity.references):
            if ref.parent in parents:
                rows = quality.flag_reference(rows, ref, parents[ref.parent], self.entity.key, f"_found{i}")
                flags.append(F.when(~F.col(f"_found{i}"), F.lit(ref.field)))
        found = F.array_compact(F.array(*flags)) if flags else F.array().cast("array<string>")
        return rows.withColumn("_missing", found)

    def add(self, children: DataFrame, parents: Mapping[str, DataFrame]) -> dict:
        """Children that passed their other rules, one row per key, against all parents there are."""
        judged = self._judge(children.select(*self.entity.columns), parents)
        with staged(judged.select(*self.parked.columns), "references") as judged:
            return self._settle(judged)

    def new_parents(self, parents: Mapping[str, DataFrame]) -> dict:
        """Parents that were not there when rows were parked; only parked rows are read."""
        waiting = [r.field for r in self.entity.references if r.parent in parents]
        asked = self.parked.read().withColumnRenamed("_missing", "_was").filter(
            F.arrays_overlap("_was", F.array(*map(F.lit, waiting))))
        judged = self._judge(asked, parents)
        still = F.array_intersect("_was", F.array_union("_missing", F.array_except("_was", F.array(*map(F.lit, waiting)))))
        moved = judged.withColumn("_missing", still).filter(F.size("_missing") < F.size("_was"))
        with staged(moved.select(*self.parked.columns), "late-parents") as moved:
            return self._settle(moved)

    def _settle(self, judged: DataFrame) -> dict:
        complete, waiting = judged.filter("size(_missing) = 0"), judged.filter("size(_missing) > 0")
        # curated first: a run that dies in between leaves a row in both, and its repetition removes it
        self.curated.change(complete.select(*self.curated.columns))
        self.parked.change(waiting, complete.select(self.entity.key))
        return judged.agg(F.count_if(F.size("_missing") == 0).alias("curated"),
                          F.count_if(F.size("_missing") > 0).alias("parked")).first().asDict()
