"""The mart as stored layers: built once, then kept up with closed months that are loaded again, by what they change."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linemart.functions.columns import assign_geography_id
from linemart.operators import facts, refresh
from linemart.operators.gapfill import carried_intervals, interior_locf
from linemart.operators.held import checkpointed
from linemart.operators.identity import normalise
from linemart.operators.refresh import matching
from linemart.sources.tables import claimed, current_version, globbed, publish_claimed, read_published

LICENCE_CELL, FACT_CELL = ["licence", "geography_id", "month"], ["provider_id", "geography_id", "month"]
#: Layers that can be made of the reports again: stored or not.
DETAIL = ("filled", "licence_geo", "fact")
MANIFEST = "layer string, folder string, batch int"
#: Reports to a part where facts are made of them: a report gives many months.
PART_REPORTS = 40_000


class StoredMart:
    """Layers in partitions by month and by a hash of their place, all under one manifest, so that all change at once or not at all.

    reports (one a series and month), series (its months), reporters (who said what of a licence), filled, licence_geo, fact,
    provider_month (counters that add up) and market. The manifest names the batch that holds each partition; a reload writes
    only partitions with rows that it changes, and readers of an earlier version keep their files. The driver holds the
    manifest, one short row a partition, and no data. Reports without a month give nothing; null key parts are equal to each
    other; two reports of one key are an error.

    A mart built without detail does not store filled, licence_geo and fact, which are many times as large as the reports: it
    makes them of the reports where they are asked for, and a reload makes the facts that it reaches, as they were and as they are.
    """

    def __init__(self, spark: SparkSession, path: str, series: list[str]) -> None:
        self.spark, self.path, self.series, self.key = spark, path, series, [*series, "month"]
        self.version, self.held, self.next, self.schemas, self.parts, self.detail = None, {}, {}, {}, 0, True
        self.refresh()

    def refresh(self) -> None:
        """Takes up the version that is current now."""
        self.version = current_version(self.spark, f"{self.path}/manifest")
        if self.version is not None:
            layout = self.spark.read.parquet(f"{self.path}/layout").collect()
            self.parts, self.schemas = layout[0]["parts"], {r.layer: T.StructType.fromJson(json.loads(r.schema)) for r in layout}
            self.detail = "fact" in self.schemas
            self.held = {}
            for r in read_published(self.spark, f"{self.path}/manifest").collect():
                self.held.setdefault(r.layer, {})[r.folder] = r.batch
        self.next = {layer: dict(folders) for layer, folders in self.held.items()}

    def layer(self, name: str, folders: set[str] | None = None, before: bool = False) -> DataFrame:
        """A layer, or the partitions asked for; of a reload under way what it makes, or what was before. Filters on the month reach the folders."""
        if name in DETAIL and not self.detail:
            filled = lambda: interior_locf(self.layer("reports", before=before), self.series)
            cells = lambda: facts.licence_geo_month(normalise(filled(), self.layer("reporters", before=before)))
            return filled() if name == "filled" else cells() if name == "licence_geo" else facts.resolve_licences(cells())
        schema, there = self.schemas[name], (self.held if before else self.next).get(name, {})
        files = [f"{self.path}/data/{name}/batch={n}/{folder}" for folder, n in sorted(there.items()) if folders is None or folder in folders]
        if not files:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/data/{name}").parquet(*files).select(*schema.names)

    def share_cells(self) -> DataFrame:
        return refresh.provider_month_of(self.layer("provider_month"))

    def build(self, reports: DataFrame, parts: int | None = None, rows: int = 250_000, detail: bool = True) -> None:
        """All layers from all reports, in so many parts a month, or as many as give parts of so many reports on average."""
        if self.version is not None:
            raise ValueError(f"{self.path} holds a mart already")
        dated = checkpointed(reports.filter(F.col("month").isNotNull()))  # read twice: what they are made of is not
        n, months = self._one_each(dated)
        number, self.parts, self.detail = claimed(self.spark, self.path), parts or max(1, -(-n // (max(1, months) * rows))), detail
        made = {
            "reports": lambda: dated,
            "series": lambda: refresh.report_months(self.layer("reports"), self.series),
            "reporters": lambda: refresh.reporter_counts(self.layer("reports")),
            "filled": lambda: interior_locf(self.layer("reports"), self.series),
            "licence_geo": lambda: facts.licence_geo_month(normalise(self.layer("filled"), self.layer("reporters"))),
            "fact": lambda: facts.resolve_licences(self.layer("licence_geo")),
            "provider_month": lambda: refresh.provider_counters(self.layer("fact")) if detail else refresh.counters_of_reports(self._resolved(), self._tasks(n)),
            "market": lambda: facts.market_totals(self.share_cells()),
        }
        for name, rows in made.items():
            if name in DETAIL and not detail:
                continue
            df = rows()
            self.schemas[name] = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
            self._write(name, df, number)
        layout = [(name, schema.json(), self.parts) for name, schema in self.schemas.items()]
        self.spark.createDataFrame(layout, "layer string, schema string, parts int").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/layout")
        self._publish(number)

    def reload(self, batch: DataFrame) -> dict[str, int]:
        """Reports put in the place of those of the same key, or added, and everything that follows from them. Gives how many partitions of each layer were written.

        Equal to building all again. A changed report reaches the months up to the next one of its series, and those since the
        last one if the series goes on after a gap; if it changes who a licence is (its latest tax id, a test name), all months
        of those it is about. Of these rows come the cells by licence, then by provider, that are made again; what markets
        lose and gain is added to their counters. A batch that changes nothing publishes nothing.
        """
        if self.version is None:
            raise ValueError(f"{self.path} holds no mart")
        reports = checkpointed(batch.filter(F.col("month").isNotNull()).select(*self.schemas["reports"].names))
        self._one_each(reports)
        at = self._folders("reports", reports)
        changed = checkpointed(refresh.changed_reports(self.layer("reports", at), reports, self.key))
        if changed.isEmpty():
            return {}
        number, written = claimed(self.spark, self.path), {}

        def replace(name: str, units: DataFrame, key: list[str], rows: DataFrame, reach: DataFrame | None = None) -> None:
            """In the partitions of the units (or of `reach`) rows take the place of those with the units' keys."""
            touched = self._folders(name, units if reach is None else reach)
            rest = matching(self.layer(name, touched, before=True), units, key, "left_anti")
            written[name] = self._write(name, rest.unionByName(rows), number, touched)

        gone = checkpointed(matching(self.layer("reports", self._folders("reports", changed)), changed, self.key))
        replace("reports", changed, self.key, changed)
        merged = checkpointed(refresh.merged_months(self.layer("series", self._folders("series", changed)), changed, self.series))
        replace("series", merged, self.series, merged.drop("before"))
        turned = refresh.reporter_counts(gone, -1).unionByName(refresh.reporter_counts(changed))
        reach = self._folders("reporters", turned)
        written["reporters"] = self._write("reporters", refresh.added_up([self.layer("reporters", reach), turned], refresh.REPORTER, ["n"], "n"), number, reach)

        ends = checkpointed(matching(refresh.lengthened(merged, self.series), changed, self.key, "left_anti"))
        on = refresh.carried_on(self.layer("reports", self._folders("reports", ends), before=True), ends, self.series)
        fresh = refresh.refilled(changed, merged, self.series).unionByName(on)
        known = {b: self.layer("reporters", before=b) for b in (True, False)}
        other = checkpointed(refresh.other_identity(known[True], known[False]))
        moves = checkpointed(self._moves(fresh, known, other, replace) if self.detail else self._moves_of_reports(fresh, other))
        reach = self._folders("provider_month", moves)
        written["provider_month"] = self._write("provider_month", refresh.added_up([self.layer("provider_month", reach), moves], refresh.CELL, refresh.COUNTERS, "cells"), number, reach)
        markets, market = moves.select("month", "territory_id").distinct(), ["month", "territory_id"]
        replace("market", markets, market, facts.market_totals(refresh.provider_month_of(matching(self.layer("provider_month", reach), markets, market))))
        self._publish(number)
        return written

    def _moves(self, fresh: DataFrame, known: dict[bool, DataFrame], other: DataFrame, replace: Callable) -> DataFrame:
        """What market counters lose and gain by filled rows that are fresh and by reporters that are somebody else; stored detail is replaced on the way."""
        fresh = checkpointed(fresh)
        replace("filled", fresh, self.key, fresh)

        # Rows that change, or whose licence is somebody else now, and the cells they were or are in.
        series = self.layer("series").join(other.select("licence").distinct(), "licence").select(*self.series, F.explode(F.sequence(F.array_min("months"), F.array_max("months"), F.expr("interval 1 month"))).alias("month"))
        moved = self._folders("filled", series)
        place = ["licence", "month", "_place"]
        placed = lambda df: df.withColumn("_place", self._place("filled"))
        units = placed(fresh).select(*place).unionByName(placed(refresh.rows_of_reporters(self.layer("filled", moved), other)).select(*place))
        units = checkpointed(units.distinct())
        around = self._folders_at("filled", units)
        named = {b: normalise(matching(placed(self.layer("filled", around, before=b)), units, place), known[b]) for b in (True, False)}
        cells = checkpointed(named[True].select(*LICENCE_CELL).union(named[False].select(*LICENCE_CELL)).distinct())
        now = checkpointed(matching(facts.licence_geo_month(named[False]), cells, LICENCE_CELL))
        was = matching(self.layer("licence_geo", self._folders("licence_geo", cells)), cells, LICENCE_CELL)
        resolved = checkpointed(was.select(*FACT_CELL).union(now.select(*FACT_CELL)).distinct())
        replace("licence_geo", cells, LICENCE_CELL, now)
        new = checkpointed(facts.resolve_licences(matching(self.layer("licence_geo", self._folders("licence_geo", resolved)), resolved, FACT_CELL)))
        old = checkpointed(matching(self.layer("fact", self._folders("fact", resolved)), resolved, FACT_CELL))
        replace("fact", resolved, FACT_CELL, new)
        return refresh.provider_counters(old, -1).unionByName(refresh.provider_counters(new))

    def _moves_of_reports(self, fresh: DataFrame, other: DataFrame) -> DataFrame:
        """The same where no detail is stored: facts of the cells that are reached are made of the reports, as they were and as they are."""
        place = ["licence", "_place"]
        placed = lambda df: df.withColumn("_place", self._place("filled"))
        theirs = self.layer("reports").join(other.select("licence").distinct(), "licence")
        turned = refresh.rows_of_reporters(interior_locf(theirs, self.series), other)
        units = checkpointed(placed(fresh).select(*place, "month").unionByName(placed(turned).select(*place, "month")).distinct())
        columns = [*place, "provider_id", "geography_id", "month", "until", *refresh.COUNTED]
        was, now = (checkpointed(placed(self._resolved(before=b)).select(*columns)) for b in (True, False))
        at = [refresh.wanted_months(refresh.wanted_at(r, units, place)).select(*FACT_CELL) for r in (was, now)]
        cells, pair = checkpointed(at[0].union(at[1]).distinct()), ["provider_id", "geography_id"]
        tasks = self._tasks(now.count())
        old, new = (refresh.counters_of_reports(refresh.wanted_at(r, cells, pair), tasks, w) for r, w in ((was, -1), (now, 1)))
        return old.unionByName(new)

    def _resolved(self, before: bool = False) -> DataFrame:
        """Reports with the month that each is carried to, its provider and geography."""
        return normalise(carried_intervals(self.layer("reports", before=before), self.series), self.layer("reporters", before=before))

    def _tasks(self, reports: int) -> int:
        return max(self.spark.sparkContext.defaultParallelism, -(-reports // PART_REPORTS))

    # Partitions

    def _place(self, name: str) -> Column:
        """What the part of a row hashes: its parish, as geography ids spell it, its territory, or its licence."""
        if name in ("licence_geo", "fact"):
            return F.split_part("geography_id", F.lit("|"), F.lit(4))
        if name in ("provider_month", "market"):
            return F.col("territory_id")
        if name == "reporters":
            return F.col("licence")
        none = F.lit(None).cast("string")
        return F.split_part(assign_geography_id(none, none, F.col("parish_code"), none), F.lit("|"), F.lit(4))

    def _part(self, place: Column) -> Column:
        return F.pmod(F.xxhash64(F.coalesce(place, F.lit(""))), F.lit(self.parts)).cast("int")

    def _monthly(self, name: str) -> bool:
        return name not in ("series", "reporters")

    def _folders_at(self, name: str, units: DataFrame) -> set[str]:
        """The partitions of units with their places: as many at most as there are partitions."""
        part = self._part(F.col("_place"))
        picked = units.select(*[F.col("month").cast("string").alias("m")] if self._monthly(name) else [F.lit(None).alias("m")], part.alias("p")).distinct().collect()
        return {f"month={r.m}/part={r.p}" if r.m is not None else f"part={r.p}" for r in picked}

    def _folders(self, name: str, units: DataFrame) -> set[str]:
        return self._folders_at(name, units.withColumn("_place", self._place(name)))

    def _write(self, name: str, df: DataFrame, number: int, touched: set[str] | None = None) -> int:
        """Writes a layer, or its touched partitions, as a batch of its own. Partitions are split or put together by their size as they are written."""
        by = ["month", "part"] if self._monthly(name) else ["part"]
        rows = df.withColumn("part", self._part(self._place(name)))
        where = f"{self.path}/data/{name}/batch={number}"
        rows.hint("rebalance", *[F.col(c) for c in by]).write.partitionBy(*by).parquet(where)
        self.next[name] = {f: n for f, n in self.next.get(name, {}).items() if touched is not None and f not in touched}
        found = globbed(self.spark, where, "/".join(f"{c}=*" for c in by))
        self.next[name] |= dict.fromkeys(found, number)
        return len(found)

    def _one_each(self, reports: DataFrame) -> tuple[int, int]:
        """(rows, months) of reports, each of which must be the only one of its key."""
        counted = reports.groupBy(*self.key).agg(F.count("*").alias("n"))
        found = counted.agg(F.count("*").alias("rows"), F.count_distinct("month").alias("months"), F.max_by(F.struct("n", *self.key), "n").alias("most")).first()
        if found["rows"] and found["most"]["n"] > 1:
            raise ValueError(f"there are {found['most']['n']} reports of the key {tuple(found['most'][k] for k in self.key)}")
        return found["rows"], found["months"]

    def _publish(self, number: int) -> None:
        rows = [(layer, folder, n) for layer, folders in self.next.items() for folder, n in folders.items()]
        publish_claimed(self.spark, self.spark.createDataFrame(rows, MANIFEST).coalesce(1), self.path, number, self.version)
        self.refresh()
