"""Shared folders and small helpers of the operators."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..shipping import ship

_LOCAL: dict[str, str] = {}
_SCRATCH: list[list[str]] = []


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession, what: str) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    Where that setting is absent, a local master gets a folder of this machine; a cluster is refused, as its executors
    would not share it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL:
            _LOCAL[app] = tempfile.mkdtemp(prefix="fundscope-")
            spark.sparkContext.setCheckpointDir(_LOCAL[app])
        root = _LOCAL[app]
    path = f"{root.rstrip('/')}/{what}-{uuid.uuid4().hex}"
    for paths in _SCRATCH[-1:]:
        paths.append(path)
    return path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def result_only(spark: SparkSession, make, what: str) -> DataFrame:
    """The frame that ``make()`` gives, as a table; the shared folders that it made on the way are deleted."""
    path = shared_dir(spark, what)
    _SCRATCH.append([])
    try:
        return written(make(), path)
    finally:
        for p in _SCRATCH.pop():
            discard(spark, p)


def written(df: DataFrame, path: str, compression: str | None = None) -> DataFrame:
    """``df`` written as Parquet and read again: later steps start from the files, not from the lineage."""
    df.write.mode("overwrite").parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Plan nodes that give at most one row for each row of the file that they read.
_ONE_FOR_ONE = {"Project", "Filter", "SubqueryAlias", "View"}
#: Files whose numbers are broadcast, 16 bytes each; more are joined in a shuffle.
MOST_FILES = 1 << 21


def _scans_files(df: DataFrame) -> bool:
    """Whether ``df`` only selects from one set of files: then a row's place in its file is the row's own."""
    node = df._jdf.queryExecution().analyzed()
    while node.getClass().getSimpleName() in _ONE_FOR_ONE and node.children().size() == 1:
        node = node.children().head()
    return node.getClass().getSimpleName() == "LogicalRelation" and "HadoopFsRelation" in node.relation().getClass().getSimpleName()


def with_row_key(docs: DataFrame, key: str = "_row") -> DataFrame:
    """``docs`` with ``key``, a number of its own for each row and the same in every reading.

    It is the row's place in its Parquet file and the file's place among all.  A frame that does more than select rows and
    columns of files (joins, unions, generators) is written first, as its rows may share such places.  The files' places
    are a table that Spark makes and joins by a hash of the path; two paths of one hash are refused.  Choose a key that is
    ``unused`` in ``docs``.
    """
    spark, columns = docs.sparkSession, docs.columns
    file, at, place = unused(docs, "_file"), unused(docs, "_at"), unused(docs, "_place")
    hidden = {c: unused(docs, f"own{c}") for c in columns if c.lower() == "_metadata"}
    rows = docs
    try:
        if hidden or not _scans_files(docs):
            raise AnalysisException("not a plain scan")
        rows.select("_metadata.row_index").schema  # noqa: B018
    except AnalysisException:
        rows = written(docs.withColumnsRenamed(hidden), shared_dir(spark, "keyed"))
    path = F.col("_metadata.file_path")
    files = rows.select(path.alias(place)).distinct().select(F.xxhash64(place).alias(file), F.row_number().over(Window.orderBy(place)).alias(place))
    files = written(files, shared_dir(spark, "files"))
    n, distinct = files.agg(F.count(F.lit(1)), F.count_distinct(file)).first()
    if n != distinct:
        raise ValueError("two files have one hash; write the table again")
    numbers = F.broadcast(files) if n <= MOST_FILES else files.hint("merge")
    placed = rows.select("*", F.xxhash64(path).alias(file), F.col("_metadata.row_index").alias(at)).withColumnsRenamed({v: k for k, v in hidden.items()})
    number = (F.col(place) - 1).cast("long") * (1 << 40) + F.col(at)
    return placed.join(numbers, file).select(*(F.col(f"`{c}`") for c in columns), number.alias(key))


#: Rows of neighbouring keys that one file of a side table answers for, as a power of two.
CELL = 18


def put_cells(table: DataFrame, by: list[str], within: list[str], folder: str) -> None:
    """Write ``table`` below ``folder`` in a file per value of the integers ``by``, its rows in the order of ``within``.

    Files get names of their own, so no attempt of a task touches another's; the list of them, written by Spark in one
    commit, names only those of the attempts that counted.
    """
    fs, root = open_fs(folder)
    fs.create_dir(root, recursive=True)

    def write(it):
        import pyarrow as pa

        fs, root = open_fs(folder)
        for cell, rows in groups(it, by):
            name = f"{uuid.uuid4().hex}.arrow"
            with fs.open_output_stream(f"{root}/{name}") as out, pa.ipc.new_file(out, rows.schema) as f:
                f.write_table(rows)
            yield pa.RecordBatch.from_arrays([pa.array(["_".join(map(str, cell))]), pa.array([name])], ["cell", "name"])

    names = table.repartition(*by).sortWithinPartitions(*by, *within).mapInArrow(write, "cell string, name string")
    names = written(names, f"{folder}/names")
    lists = -(-names.count() // 100_000)
    names.orderBy("cell").coalesce(max(1, lists)).write.parquet(f"{folder}/cells")


class Cells:
    """Reader of the files of ``put_cells``; holds the last ``most`` of them.

    A cell that isn't listed has no rows; one that is listed and can't be read is an error, as is a missing list.
    """

    def __init__(self, folder: str, most: int = 2):
        self.folder, self.most, self.held, self.lists, self.names = folder, most, {}, None, {}

    def _name(self, cell: str) -> str | None:
        """The cell's file.  A list of up to 100,000 names is held whole; of several, the rows asked for are read."""
        import pyarrow.compute as pc
        import pyarrow.dataset as ds
        from pyarrow import fs

        if self.lists is None:
            store, root = open_fs(self.folder)
            files = [f.path for f in store.get_file_info(fs.FileSelector(f"{root}/cells")) if f.path.endswith(".parquet")]
            if not files:
                raise FileNotFoundError(f"the list of {self.folder} is missing")
            self.lists = ds.dataset(files, filesystem=store, format="parquet")
            if len(files) == 1:
                self.names = dict(zip(*(c.to_pylist() for c in self.lists.to_table(columns=["cell", "name"]).columns), strict=True))
                self.lists = ()
        if self.lists and cell not in self.names:
            self.names[cell] = next(iter(self.lists.to_table(columns=["name"], filter=pc.field("cell") == cell).column("name").to_pylist()), None)
        return self.names.get(cell)

    def __getitem__(self, cell: tuple[int, ...]):
        """The cell's rows as an Arrow table; none, if it has no rows."""
        import pyarrow as pa

        if cell in self.held:
            return self.held[cell]
        while len(self.held) >= self.most:
            del self.held[next(iter(self.held))]
        name, table = self._name("_".join(map(str, cell))), None
        if name is not None:
            fs, root = open_fs(self.folder)
            with fs.open_input_stream(f"{root}/{name}") as f:
                table = pa.ipc.open_file(pa.BufferReader(f.read())).read_all()
        self.held[cell] = table
        return table


class Places:
    """A side table on the row keys of another one, read by the tasks that read that one's rows.

    ``put`` leaves it in the shared store in files, each for ``1 << CELL`` neighbouring keys; a task opens those of the
    rows that it reads.  So the big table, already in files, meets it without a shuffle, and nothing is broadcast.
    """

    def __init__(self, folder: str):
        self.cells = Cells(folder)

    @staticmethod
    def put(side: DataFrame, key: str, what: str) -> str:
        """Write ``side``, with a long ``key``, which may repeat."""
        folder, cell = shared_dir(side.sparkSession, what), unused(side, "cell")
        put_cells(side.withColumn(cell, F.shiftright(key, CELL)), [cell], [key], folder)
        return folder

    def matches(self, rows, key: str):
        """Pairs (place in ``rows``, one-row-per-pair table) of all rows of the side table with the keys ``rows``."""
        import numpy as np

        for k in np.unique(rows >> CELL).tolist():
            table = self.cells[(k,)]
            if table is None:
                continue
            mine, keys = np.flatnonzero(rows >> CELL == k), table.column(key).to_numpy()
            first, last = np.searchsorted(keys, rows[mine]), np.searchsorted(keys, rows[mine], "right")
            n = last - first
            at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
            yield np.repeat(mine, n), table.take(at)


def spread_join(rows: DataFrame, known: DataFrame, key: str, copies: str, most_hot: int = 50_000, least: int = 256, total: int | None = None, merge: bool = False) -> DataFrame:
    """Inner join of ``rows`` with ``known``, which has each key once and, as ``copies``, the rows that have it.

    Keys with at least 1 / ``most_hot`` of all rows are at most ``most_hot``: that part is broadcast, as a shuffle would
    bring all rows of one key to one task.  The others meet in a shuffled join; ``merge`` holds Spark to that where ``known``
    grows with the data, even while it would still fit in a broadcast.
    """
    held = (lambda df: df.hint("merge")) if merge else (lambda df: df)
    if total is None:
        total, most = known.agg(F.coalesce(F.sum(copies), F.lit(0)), F.coalesce(F.max(copies), F.lit(0))).first()
        if most < max(least, -(-total // most_hot)):
            return rows.join(held(known), key)
    hot = F.col(copies) >= max(least, -(-total // most_hot))
    many = known.filter(hot)
    few = rows.join(F.broadcast(many.select(key)), key, "left_anti")
    return rows.join(F.broadcast(many), key).unionByName(few.join(held(known.filter(~hot)), key))


def rows_at(keyed: DataFrame, chosen: DataFrame, key: str, like: DataFrame) -> DataFrame:
    """The rows of ``keyed`` whose ``key`` is in ``chosen``, in the columns of ``like``, found by their places."""
    folder, columns = Places.put(chosen.select(key), key, "chosen"), like.columns

    def run(it):
        import pyarrow as pa

        from .words import release

        side = Places(folder)
        for batch in it:
            for at, _ in side.matches(batch.column(key).to_numpy(), key) if batch.num_rows else ():
                yield batch.select(columns).take(pa.array(at))
        side = batch = at = _ = None
        release()

    return keyed.mapInArrow(run, like.schema)


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have; names are compared without case, as Spark does."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def unit(h) -> "F.Column":
    """A hash of 64 bits as a number from 0 to below 1."""
    return F.shiftrightunsigned(h, 11) / float(1 << 53)


def crc_of_id(col) -> "F.Column":
    """crc32 of the id written as text."""
    return F.crc32(col.cast("string").cast("binary"))


def open_fs(uri: str):
    """(pyarrow file system, path) of a folder in the shared store; works in the driver and in executors."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else uri.replace("file:", "", 1))


def groups(it, keys: list[str]):
    """(key, table) for each run of rows with equal keys in a stream of Arrow batches sorted by them.

    Only the rows of one group are held.  Keys are integers without nulls.
    """
    import numpy as np
    import pyarrow as pa

    from .words import release

    held, last = [], None
    for batch in it:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(int(c[a]) for c in cols)
            if held and key != last:
                yield last, pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield last, pa.Table.from_batches(held)
    release()
