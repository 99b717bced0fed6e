"""A tree of hashes over ordered lines, kept beside them and brought up to date by path.

A leaf is the hash of a line, a node the hash of up to ``FAN`` children with their
places; the node at level l and place i covers the lines from i * FAN^l on. The root
depends on every line and its place, and not on how rows are dealt to tasks or
in how many appends the lines came. No task meets more than ``FAN`` hashes of a node.

An append writes its leaves and the nodes above them, and reads of what is kept
only the other children of these nodes; everything else stays as it was. A line at a place that is
taken replaces the line there. An append counts once its root is written, which is the last
write; one that was lost on the way is written anew. One
writer at a time appends.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of a place that one level covers, and the children of a node.
BITS = 6
FAN = 1 << BITS
NODE = "node bigint, n bigint, hash string, append int, level int"
ROOT = "levels int, n bigint, root string, append int"


def leaf_hash(line: Column) -> Column:
    """The hash of a line; a null line differs from an empty one."""
    return F.sha2(F.coalesce(F.concat(F.lit("0:"), line), F.lit("-")), 256)


def node_hash(children: Column) -> Column:
    """The hash of an array of (i, hash) in the order of ``i``."""
    return F.sha2(F.concat(F.lit("1:"), F.array_join(F.transform(children, lambda c: F.concat_ws(":", c["i"].cast("string"), c["hash"])), ",")), 256)


def _place(node: Column) -> Column:
    return node.bitwiseAND(F.lit(FAN - 1)).cast("int")


def parents(children: DataFrame) -> DataFrame:
    """(node, n, hash) one level up, of (node, n, hash). Rows repeated whole are one; two lines at one place are an error."""
    kept = F.array_sort(F.collect_set(F.struct(_place(F.col("node")).alias("i"), "hash", "n")))
    grouped = children.groupBy(F.shiftright("node", BITS).alias("node")).agg(kept.alias("c"))
    places = F.transform("c", lambda c: c["i"])
    clash = F.size(F.array_distinct(places)) < F.size(places)
    hashed = F.when(clash, F.raise_error(F.lit("two lines at one place"))).otherwise(node_hash(F.col("c")))
    return grouped.select("node", F.aggregate("c", F.lit(0).cast("bigint"), lambda a, c: a + c["n"]).alias("n"), hashed.alias("hash"))


def climbed(leaf: Column, at: Column, path: Column) -> Column:
    """The root that a leaf's hash and its path (array of (level, children)) lead to; null where the leaf isn't on that path."""

    def step(below: Column, s: Column) -> Column:
        place = F.pmod(F.floor(at / F.pow(F.lit(float(FAN)), s["level"] - 1)).cast("bigint"), F.lit(FAN))
        return F.when(F.exists(s["children"], lambda c: (c["i"] == place) & (c["hash"] == below)), node_hash(s["children"]))

    return F.aggregate(path, leaf, step)


class MerkleTree:
    """The tree that is kept at ``path``, a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _files(self, name: str):
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), folder

    def roots(self) -> DataFrame:
        """(levels, n, root, append) of each append that counts."""
        files, folder = self._files("roots")
        if not files.exists(folder):
            return self.spark.createDataFrame([], ROOT)
        return self.spark.read.schema(ROOT).parquet(f"{self.path}/roots")

    def _last(self):
        return self.roots().orderBy(F.desc("append")).first()

    def root(self) -> str | None:
        """The root of all lines; None of none."""
        last = self._last()
        return last.root if last else None

    def _stored(self, level: int, before: int) -> DataFrame:
        """All nodes of a level that appends before this one wrote, of a place several."""
        found = self.spark.read.schema(NODE).parquet(f"{self.path}/nodes")
        return found.where((F.col("level") == level) & (F.col("append") < before))

    @staticmethod
    def _newest(nodes: DataFrame) -> DataFrame:
        return nodes.groupBy("node").agg(F.max_by(F.struct("n", "hash"), "append").alias("_x")).select("node", "_x.*")

    def nodes(self, level: int) -> DataFrame:
        """(node, n, hash) of a level."""
        last = self._last()
        if last is None:
            return self.spark.createDataFrame([], "node bigint, n bigint, hash string")
        return self._newest(self._stored(level, last.append + 1))

    def _write(self, nodes: DataFrame, append: int, level: int) -> DataFrame:
        """The nodes as they are read again."""
        folder = f"{self.path}/nodes/append={append}/level={level}"
        nodes.write.mode("overwrite").parquet(folder)
        return self.spark.read.schema("node bigint, n bigint, hash string").parquet(folder)

    def append(self, lines: DataFrame, at: str = "seq", value: str = "value") -> str | None:
        """Takes lines in and returns the new root. Places are whole numbers from 0 on; gaps are allowed, nulls an error."""
        last = self._last()
        k, known = (last.append + 1, last.levels) if last else (0, 0)
        files, lost = self._files(f"nodes/append={k}")
        files.delete(lost, True)  # of an append that never came to its root
        place = F.col(at).cast("bigint")
        checked = F.when(place >= 0, place).otherwise(F.raise_error(F.lit("a line without a place")).cast("bigint"))
        changed = self._write(lines.select(checked.alias("node"), F.lit(1).cast("bigint").alias("n"), leaf_hash(F.col(value)).alias("hash")), k, 0)
        span = changed.agg(F.min("node"), F.max("node")).first()
        if span[0] is None:
            return last.root if last else None
        levels = max(known, 1, -(-int(span[1]).bit_length() // BITS))
        low, high = span
        for level in range(1, levels + 1):
            children = changed
            low, high = low >> BITS, high >> BITS
            if level - 1 == known and last:
                low = 0  # the tree grows: what was its root has new nodes above it
            if last and level - 1 <= known:
                # of the nodes to be hashed anew, the children that stay
                near = self._stored(level - 1, k).where(F.col("node").between(low << BITS, (high << BITS) + FAN - 1))
                above = changed.select(F.shiftright("node", BITS).alias("_above"))
                if level - 1 == known:
                    above = above.unionByName(self.spark.range(1).select(F.col("id").alias("_above")))
                near = near.withColumn("_above", F.shiftright("node", BITS)).join(above.distinct(), "_above", "left_semi").drop("_above")
                stay = self._newest(near).join(changed.select("node"), "node", "left_anti")
                children = changed.unionByName(stay)
            changed = self._write(parents(children), k, level)
        top = changed.where("node = 0").select(F.lit(levels).alias("levels"), "n", F.col("hash").alias("root"))
        top.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/roots/append={k}")
        return self.root()

    def proofs(self, places: DataFrame, at: str = "at") -> DataFrame:
        """(at, path) of places: for each level the children of the node above the place, as ``climbed`` takes them.

        Places that hold no line have no row.
        """
        last = self._last()
        if last is None:
            return self.spark.createDataFrame([], "at bigint, path array<struct<level int, children array<struct<i int, hash string>>>>")
        wanted = places.select(F.col(at).cast("bigint").alias("at")).distinct()
        steps = []
        for level in range(1, last.levels + 1):
            asked = wanted.select("at", F.shiftright("at", BITS * level).alias("above"))
            near = self._stored(level - 1, last.append + 1).withColumn("above", F.shiftright("node", BITS)).join(asked.select("above").distinct(), "above", "left_semi")
            children = F.array_sort(F.collect_list(F.struct(_place(F.col("node")).alias("i"), "hash")))
            groups = self._newest(near).groupBy(F.shiftright("node", BITS).alias("above")).agg(children.alias("children"))
            steps.append(asked.join(groups, "above").select("at", F.struct(F.lit(level).alias("level"), "children").alias("step")))
        held = self._newest(self._stored(0, last.append + 1).join(wanted.withColumnRenamed("at", "node"), "node", "left_semi")).select(F.col("node").alias("at"))
        paths = reduce(DataFrame.unionByName, steps).groupBy("at").agg(F.array_sort(F.collect_list("step")).alias("path"))
        return paths.join(held, "at", "left_semi")
