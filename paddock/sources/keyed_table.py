"""A table with one row for each key that takes small batches without being rewritten.

Rows are dealt to buckets by a hash of their key. A batch is written as one layer of files that holds its
rows and no others; readers take a bucket's layers together and keep the latest row of each key. A
manifest names the layers of every bucket and is put in place at the end of each change, so that a
change that is killed leaves the table as it was. Compaction folds the layers of the buckets that
have most of them into one. There is one writer at a time; readers go on with the manifest that they
have read, whose files stay for ``keep`` further changes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import Files

P = F.col
#: Columns that a layer's files have besides the table's.
SEQUENCE, BUCKET = "_sequence", "_bucket"


class KeyedTable:
    """``keys`` name a row; of several the largest ``updated`` counts, of equal ones the later change, then
    ``tie`` descending. All but ``path`` must be the same for every writer and are kept in the manifest."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] | None = None, updated: str | None = None, tie: Sequence[str] = (), buckets: int = 64):
        self.spark, self.path, self.files = spark, path.rstrip("/"), Files(spark, path)
        known = self.manifest()
        if known is None and (keys is None or updated is None):
            raise FileNotFoundError(f"no table at {path}")
        rule = known["rule"] if known else {"keys": list(keys), "updated": updated, "tie": list(tie), "buckets": buckets}
        if keys is not None and known and (list(keys), updated) != (rule["keys"], rule["updated"]):
            raise ValueError(f"the table has keys {rule['keys']} and {rule['updated']}")
        self.rule = rule

    # -- manifests ------------------------------------------------------------------------------

    def versions(self) -> list[int]:
        return [int(n[9:-5]) for n in self.files.names() if n.startswith("manifest-") and n.endswith(".json")]

    def manifest(self, version: int | None = None) -> dict | None:
        """version, rule, schema, layers by bucket ([layer, rows], oldest first), tokens of batches."""
        found = self.versions() if version is None else [version]
        return json.loads(self.files.read(f"manifest-{found[-1]:012d}.json")) if found else None

    def _commit(self, before: dict | None, **changes) -> dict:
        base = before or {"version": -1, "rule": self.rule, "schema": None, "layers": {}, "tokens": []}
        after = base | changes | {"version": base["version"] + 1}
        self.files.create(f"manifest-{after['version']:012d}.json", json.dumps(after))
        return after

    # -- writing --------------------------------------------------------------------------------

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.rule["keys"]), F.lit(self.rule["buckets"])).cast("int")

    def _latest(self, rows: DataFrame) -> DataFrame:
        order = [F.desc(self.rule["updated"]), F.desc(SEQUENCE), *[F.desc(t) for t in self.rule["tie"]]]
        w = Window.partitionBy(BUCKET, *self.rule["keys"]).orderBy(*order)
        return rows.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")

    def _write(self, rows: DataFrame, layer: str) -> dict[str, int]:
        """Files of a layer, one folder a bucket; rows by bucket, as Spark has written them."""
        rows.write.partitionBy(BUCKET).parquet(f"{self.path}/{layer}")
        written = self.spark.read.schema(rows.schema).parquet(f"{self.path}/{layer}")
        return {str(r[0]): r[1] for r in written.groupBy(BUCKET).count().collect()}  # one row a bucket, from the files' footers

    def apply(self, batch: DataFrame, token: str | None = None) -> dict:
        """Merge a batch; what is written is the batch. A batch whose ``token`` has been merged is left out."""
        before = self.manifest()
        if before and token is not None and token in before["tokens"]:
            return before
        number = before["version"] + 1 if before else 0
        rows = batch.withColumns({SEQUENCE: F.lit(number).cast("long"), BUCKET: self._bucket()})
        layer = f"layer-{number:012d}-{uuid.uuid4().hex}"
        counts = self._write(self._latest(rows.repartition(BUCKET)), layer)
        layers = dict(before["layers"]) if before else {}
        for bucket, n in counts.items():
            layers[bucket] = [*layers.get(bucket, []), [layer, n]]
        tokens = [*(before["tokens"] if before else []), *([token] if token is not None else [])][-1_000:]
        return self._commit(before, layers=layers, tokens=tokens, schema=batch.schema.jsonValue())

    def compact(self, most: int = 8, least_layers: int = 2) -> dict | None:
        """Fold the layers of the ``most`` buckets that have most of them, two at least, into one."""
        before = self.manifest()
        full = sorted((b for b, x in before["layers"].items() if len(x) >= least_layers), key=lambda b: (-len(before["layers"][b]), int(b)))[:most]
        if not full:
            return None
        layer = f"layer-{before['version'] + 1:012d}-{uuid.uuid4().hex}"
        rows = self._scan(before, {b: before["layers"][b] for b in full}).repartition(BUCKET)
        counts = self._write(self._latest(rows), layer)
        return self._commit(before, layers=before["layers"] | {b: [[layer, counts[b]]] for b in full})

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove manifests but the last ``keep``, and layers that none of these names."""
        last = self.versions()[-keep:]
        used = {layer for v in last for x in self.manifest(v)["layers"].values() for layer, _ in x}
        gone = [n for n in self.files.names() if (n.startswith("layer-") and n not in used) or (n.startswith("manifest-") and int(n[9:-5]) not in last) or n.endswith(".part")]
        for name in gone:
            self.files.remove(name)
        return gone

    # -- reading --------------------------------------------------------------------------------

    def _scan(self, manifest: dict, layers: dict[str, list]) -> DataFrame:
        from pyspark.sql.types import StructType

        schema = StructType.fromJson(manifest["schema"]).add(SEQUENCE, "long")
        paths = sorted(f"{self.path}/{layer}/{BUCKET}={b}" for b, x in layers.items() for layer, _ in x)
        rows = self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        return rows.withColumn(BUCKET, self._bucket())

    def _merged(self, manifest: dict, buckets: Sequence[str]) -> DataFrame:
        return self._latest(self._scan(manifest, {b: manifest["layers"][b] for b in buckets}))

    def read(self, version: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """The table, or some of its buckets. Buckets with one layer are read as they are; only the others'
        rows meet in a shuffle."""
        manifest = self.manifest(version)
        wanted = {b: x for b, x in manifest["layers"].items() if buckets is None or int(b) in set(buckets)}
        clean = self._scan(manifest, {b: x for b, x in wanted.items() if len(x) == 1})
        dirty = [b for b, x in wanted.items() if len(x) > 1]
        out = clean.unionByName(self._merged(manifest, dirty)) if dirty else clean
        return out.drop(SEQUENCE, BUCKET)

    def lookup(self, asked: DataFrame) -> DataFrame:
        """Rows of the keys in ``asked``; only the buckets that these fall into are read."""
        hit = [r[0] for r in asked.select(self._bucket().alias("b")).distinct().collect()]  # at most one row a bucket
        return self.read(buckets=hit).join(asked.select(*self.rule["keys"]).distinct(), self.rule["keys"], "left_semi")
