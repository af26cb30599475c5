"""The given tables in the shape of races, runs and horses, for Spark and for DuckDB."""

from __future__ import annotations

import zlib
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


class Views:
    """Lazily built views over the parquet tables of a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def races(self) -> DataFrame:
        o, c = self.table("orders"), self.table("customer")
        n, r = self.table("nation"), self.table("region")
        k = F.col("o_orderkey")
        going = F.element_at(F.array(*map(F.lit, ("Firm", "Good To Firm", "Good", "Soft", "Heavy"))), (k % 5 + 1).cast("int"))
        surface = F.element_at(F.array(*map(F.lit, ("Turf", "AW", "Hurdle"))), (k % 3 + 1).cast("int"))
        return (
            o.join(c, o.o_custkey == c.c_custkey)
            .join(n, n.n_nationkey == c.c_nationkey)
            .join(r, r.r_regionkey == n.n_regionkey)
            .select(
                k.alias("race_id"), F.to_date("o_orderdate").alias("race_date"), F.col("c_nationkey").alias("course_id"), F.col("r_name").alias("region"),
                F.substring("o_orderpriority", 1, 1).cast("int").alias("race_class"), going.alias("going"), surface.alias("surface"),
                (k % 16 + 5).cast("int").alias("distance_f"), F.col("o_totalprice").alias("prize"), F.col("o_custkey").alias("owner_id"),
            )
        )

    @cached_property
    def runs(self) -> DataFrame:
        """One row for each horse in a race, with the race's columns."""
        line = self.table("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag")
        s = self.table("supplier").select("s_suppkey", "s_nationkey")
        joined = line.join(s, line.l_suppkey == s.s_suppkey).join(self.races, line.l_orderkey == F.col("race_id"))
        code = F.expr("case when l_linenumber = 7 then 'PU' when l_linenumber = 6 and l_returnflag = 'R' then 'F' end")
        # both windows lie within a race and its date: conditions on the date reach the scans, and one shuffle by race does
        race = Window.partitionBy("race_id", "race_date")
        by_horse = race.orderBy("l_partkey", F.desc("l_extendedprice"), "l_suppkey", "l_linenumber")
        lines = joined.select(*joined.columns, code.alias("code"), F.row_number().over(by_horse).alias("nth"), F.lag("l_partkey").over(by_horse).alias("before"))
        first = lines.where((F.col("nth") == 1) | ~F.col("l_partkey").eqNullSafe(F.col("before")))  # the dearest line of a horse
        ranked = race.orderBy(F.col("code").isNotNull(), F.desc("l_extendedprice"), F.asc_nulls_last("l_partkey"), "l_suppkey", "l_linenumber")
        rows = first.withColumn("rank", F.row_number().over(ranked))
        place = F.when(F.col("code").isNull(), F.col("rank"))
        share = F.when(place == 1, 2).when(place == 2, 4).when(place == 3, 8)
        return rows.select(
            "race_id", F.col("l_partkey").alias("horse_id"), F.col("l_suppkey").alias("jockey_id"), F.col("s_nationkey").alias("trainer_id"), "owner_id",
            (1 + F.col("l_quantity") / 4).alias("sp_decimal"), F.coalesce("code", F.col("rank").cast("string")).alias("position_raw"), place.alias("position"),
            F.coalesce(F.floor(F.col("prize") / share), F.lit(0)).cast("double").alias("prize_won"),
            "race_date", "course_id", "region", "race_class", "going", "surface", "distance_f",
        )

    @cached_property
    def landed(self) -> DataFrame:
        """``runs`` as a table by month and in buckets by horse, written when first asked for."""
        from ..sources.landed import land
        from ..sources.shared import shared_folder

        name = f"runs_{zlib.crc32(f'{self.spark.sparkContext.applicationId} {self.folder}'.encode()):08x}"
        if not self.spark.catalog.tableExists(name):
            fit = self.table("lineitem").count() // 500_000  # from the files' footers; a bucket has a file in each month
            land(self.runs, name, shared_folder(self.spark, name), max(4, min(fit, int(self.spark.conf.get("spark.sql.shuffle.partitions")))))
        return self.spark.table(name)

    @cached_property
    def horses(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("horse_id"), F.col("p_name").alias("name"), F.col("p_name").alias("sire_id"),
            F.concat_ws("/", "p_brand", "p_type").alias("dam_id"), F.col("p_size").cast("string").alias("damsire_id"),
        )

    @cached_property
    def as_of(self):
        """The last race date, read once."""
        return F.lit(self.table("orders").agg(F.max(F.to_date("o_orderdate"))).first()[0])

    @cached_property
    def lineage(self) -> DataFrame:
        from ..operators.pedigree import lineage

        return lineage(self.runs.join(self.horses, "horse_id"), unique=True)

    @cached_property
    def parents(self) -> DataFrame:
        """Horses whose parents are horses of the table: sires by size, dams by halving the number, so
        that lines meet again after some generations."""
        k = F.col("p_partkey")
        sire = F.when(k >= 64, F.col("p_size").cast("long")).when(k >= 4, F.expr("p_partkey div 4"))
        return self.table("part").select(k.alias("horse_id"), sire.alias("sire_id"), F.when(k >= 8, F.expr("p_partkey div 2")).alias("dam_id"))

    @cached_property
    def ancestry(self) -> DataFrame:
        from ..operators.pedigree import ancestry

        return ancestry(self.parents)


SQL = """races AS (
  SELECT o_orderkey AS race_id, CAST(o_orderdate AS DATE) AS race_date, c_nationkey AS course_id, r_name AS region,
    CAST(substr(o_orderpriority, 1, 1) AS INT) AS race_class,
    ['Firm', 'Good To Firm', 'Good', 'Soft', 'Heavy'][o_orderkey % 5 + 1] AS going, ['Turf', 'AW', 'Hurdle'][o_orderkey % 3 + 1] AS surface,
    CAST(5 + o_orderkey % 16 AS INT) AS distance_f, o_totalprice AS prize, o_custkey AS owner_id
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey),
line1 AS (
  SELECT *, CASE WHEN l_linenumber = 7 THEN 'PU' WHEN l_linenumber = 6 AND l_returnflag = 'R' THEN 'F' END AS code,
    row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_extendedprice DESC, l_suppkey, l_linenumber) AS rn FROM lineitem),
line2 AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY code IS NOT NULL, l_extendedprice DESC, l_partkey, l_suppkey, l_linenumber) AS rank
  FROM line1 WHERE rn = 1),
runs AS (
  SELECT race_id, l_partkey AS horse_id, l_suppkey AS jockey_id, s_nationkey AS trainer_id, owner_id, 1 + l_quantity / 4 AS sp_decimal,
    coalesce(code, CAST(rank AS VARCHAR)) AS position_raw, CASE WHEN code IS NULL THEN rank END AS position,
    CASE WHEN code IS NULL AND rank = 1 THEN floor(prize / 2) WHEN code IS NULL AND rank = 2 THEN floor(prize / 4)
      WHEN code IS NULL AND rank = 3 THEN floor(prize / 8) ELSE 0 END AS prize_won,
    race_date, course_id, region, race_class, going, surface, distance_f
  FROM line2 JOIN supplier ON s_suppkey = l_suppkey JOIN races ON race_id = l_orderkey),
horses AS (
  SELECT p_partkey AS horse_id, p_name AS name, p_name AS sire_id, p_brand || '/' || p_type AS dam_id, CAST(p_size AS VARCHAR) AS damsire_id FROM part),
ended AS (SELECT max(race_date) AS d FROM races),
lineage AS (
  SELECT race_id, horse_id, 1 AS generation, 'sire' AS relation, sire_id AS ancestor_id, position, prize_won, race_date, race_class, surface, distance_f FROM runs JOIN horses USING (horse_id)
  UNION ALL SELECT race_id, horse_id, 1, 'dam', dam_id, position, prize_won, race_date, race_class, surface, distance_f FROM runs JOIN horses USING (horse_id)
  UNION ALL SELECT race_id, horse_id, 2, 'damsire', damsire_id, position, prize_won, race_date, race_class, surface, distance_f FROM runs JOIN horses USING (horse_id))
"""
#: Recursive, so it stands apart: put it before the other views and begin with WITH RECURSIVE.
ANCESTRY_SQL = """parents AS (
  SELECT p_partkey AS horse_id, CASE WHEN p_partkey >= 64 THEN p_size::BIGINT WHEN p_partkey >= 4 THEN p_partkey // 4 END AS sire_id, CASE WHEN p_partkey >= 8 THEN p_partkey // 2 END AS dam_id FROM part),
steps AS (
  SELECT * FROM (SELECT horse_id AS child, 'sire' AS step, sire_id AS parent FROM parents UNION ALL SELECT horse_id, 'dam', dam_id FROM parents) WHERE parent <> child),
chains AS (
  SELECT child AS horse_id, parent AS ancestor_id, 1 AS generation, step AS path, [child, parent] AS chain FROM steps
  UNION ALL SELECT horse_id, parent, generation + 1, path || '.' || step, list_append(chain, parent) FROM chains JOIN steps ON ancestor_id = child
  WHERE generation < 4 AND NOT list_contains(chain, parent)),
ancestry AS (SELECT horse_id, ancestor_id, generation, path FROM chains)"""
