"""Datasets and their registry.

A dataset is a directory ``<root>/<uid>/<commit>/split_type=<s>`` (Parquet, CSV or array
bundles); the registry is an append-only Parquet table ``<root>/_registry`` with one row per
(uid, split, commit) holding lineage ids, split parameters, column order and
position map, class weights and free-form metadata. Every write is a commit with the next
version of its uid: readers see the latest version, and of two writers that take the same
version at once at most one goes through. Lookups are filters on the
registry (pushed down to the scan); file listings come from the
``binaryFile`` source with the content column pruned.
"""

from __future__ import annotations

import datetime as _dt
import json
import os
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.splits import SPLIT_COL, split_ordered, split_shuffled
from ..schema import CAMPAIGN_SCHEMA, normalise
from ..session import materialize, settle
from .npz import read_npz, write_npz

REGISTRY_SCHEMA = T.StructType([
    T.StructField("uid", T.StringType()), T.StructField("parent_uid", T.StringType()),
    T.StructField("encoder_uid", T.StringType()), T.StructField("split_type", T.StringType()),
    T.StructField("path", T.StringType()), T.StructField("format", T.StringType()),
    T.StructField("schema", T.StringType()),
    T.StructField("created", T.TimestampType()), T.StructField("random_state", T.LongType()),
    T.StructField("test_size", T.DoubleType()), T.StructField("stratify_variable", T.StringType()),
    T.StructField("shuffle", T.BooleanType()), T.StructField("n_rows", T.LongType()),
    T.StructField("column_order", T.ArrayType(T.StringType())),
    T.StructField("column_position_map", T.MapType(T.StringType(), T.IntegerType())),
    T.StructField("class_weight", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
    T.StructField("version", T.LongType()), T.StructField("commit", T.StringType()),
    T.StructField("aborted", T.BooleanType()),
])

META_PREFIX = "x-amz-meta-"


def new_uid() -> str:
    return str(uuid.uuid4())


def file_position(df: DataFrame, out: str = "row_position") -> DataFrame:
    """Add the 0-based position of every row in the order of the files: by path, then by place
    in the file. ``df`` must be a plain file scan (Parquet, CSV, text, ...). Rows of one block of a file are
    read in order by one task, so the numbers of rows of the blocks before (a row per block) and the place after the
    block's first row give it: the rows are written once and not shuffled."""
    keyed = materialize(df.select("*", F.col("_metadata.file_path").alias("_fp"), F.col("_metadata.file_block_start").alias("_fb"),
                                  F.monotonically_increasing_id().alias("_fi")), "positioned")
    blocks = keyed.groupBy("_fp", "_fb").agg(F.count(F.lit(1)).alias("_fn"), F.min("_fi").alias("_f0"))
    before = F.sum("_fn").over(Window.orderBy("_fp", "_fb")) - F.col("_fn") - F.col("_f0")
    blocks = settle(blocks.select("_fp", "_fb", before.alias("_off")))
    return keyed.join(F.broadcast(blocks), ["_fp", "_fb"]) \
        .withColumn(out, (F.col("_off") + F.col("_fi")).cast("bigint")).drop("_fp", "_fb", "_fi", "_off")


def scan_csv(spark: SparkSession, path: str, schema: T.StructType = CAMPAIGN_SCHEMA,
             header: bool = True, options: Mapping[str, str] | None = None, position: str | None = None) -> DataFrame:
    """CSV with a declared schema, bound by header name (without a header by
    position). Every column is read as text and cast, so the column order of
    the file does not matter; columns that the schema lacks are kept as text.
    Ids arrive as strings, NaN as NULL. A missing path, absent columns, and a
    value that its declared type cannot hold raise ValueError (the last one
    as the job runs). ``options`` go to the reader (and so to the file system); ``position``
    names a column for the row's place in the files (see ``file_position``)."""
    reader = spark.read.option("header", header).option("mode", "FAILFAST").options(**(options or {}))
    try:
        df = reader.csv(path) if header else reader.schema(T.StructType(
            [T.StructField(f.name, T.StringType()) for f in schema.fields])).csv(path)
    except AnalysisException as e:
        raise ValueError(f"could not read {path}: {e}") from e
    absent = [f.name for f in schema.fields if f.name not in df.columns]
    if absent:
        raise ValueError(f"{path} lacks the columns {absent}; it has {df.columns}")
    if position:
        df = file_position(df, position)

    def typed(f):
        c = F.trim(F.col(f.name))
        if isinstance(f.dataType, T.StringType):
            return F.col(f.name).alias(f.name)
        empty = c.isNull() | F.lower(c).isin("", "nan", "null", "na")
        value = c.try_cast(f.dataType)
        if isinstance(f.dataType, T.IntegralType):  # "3.0" is a whole number
            d = c.try_cast("double")
            value = F.coalesce(value, F.when(d == F.floor(d), d.cast(f.dataType)))
        bad = F.raise_error(F.concat(F.lit(f"{f.name}: not a {f.dataType.simpleString()}: "), c))
        return F.when(empty, F.lit(None).cast(f.dataType)).when(value.isNotNull(), value) \
                .otherwise(bad.cast(f.dataType)).alias(f.name)

    declared = {f.name: f for f in schema.fields}
    extra = [c for c in df.columns if c not in declared]
    return normalise(df.select(*[typed(f) for f in schema.fields], *extra))


def scan_csv_store(spark: SparkSession, path: str, access_key: str | None = None, secret_key: str | None = None,
                   endpoint: str | None = None, options: Mapping[str, str] | None = None, **kw) -> DataFrame:
    """``scan_csv`` from an object store (``s3a://``, ``gs://``, ...). Keys given here (and any ``fs.*``
    settings in ``options``) reach the connector as options of this one reader: the session's settings
    never hold them. Without keys, those of the session or the cluster apply; ValueError when
    one of the pair is missing, or an ``s3a`` path has none at all. The connector itself comes with the cluster."""
    if (access_key is None) != (secret_key is None):
        raise ValueError("an access key needs its secret key, and the other way round")
    given = dict(options or {})
    if access_key is not None:
        given |= {"fs.s3a.access.key": access_key, "fs.s3a.secret.key": secret_key,
                  "fs.s3a.aws.credentials.provider": "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider"}
    if endpoint:
        given["fs.s3a.endpoint"] = endpoint
    settings = ("fs.s3a.access.key", "fs.s3a.aws.credentials.provider")
    if path.startswith("s3a://") and not any(k in given or spark.conf.get(f"spark.hadoop.{k}", None) for k in settings):
        raise ValueError("no object-store credentials: pass keys or set spark.hadoop.fs.s3a.*")
    return scan_csv(spark, path, options=given, **kw)


def registry_path(root: str) -> str:
    return os.path.join(root, "_registry")


def registry_log(spark: SparkSession, root: str) -> DataFrame:
    """Every registry row ever appended, aborted commits included (empty before the first dataset);
    other read failures raise."""
    try:
        return spark.read.schema(REGISTRY_SCHEMA).parquet(registry_path(root))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], REGISTRY_SCHEMA)


def _committed(log: DataFrame) -> DataFrame:
    rows = log.where("NOT coalesce(aborted, false)")
    return rows.join(log.where("aborted").select("commit").distinct(), "commit", "left_anti").select(*log.columns)


def registry(spark: SparkSession, root: str) -> DataFrame:
    """The registry: of every (uid, split) the rows of its latest version, without aborted commits. (Two rows of one
    (uid, split) are an unsettled conflict of two writers, which ``resolve`` reports.)"""
    rows = _committed(registry_log(spark, root))
    latest = F.max(F.coalesce("version", F.lit(0))).over(Window.partitionBy("uid", "split_type"))
    return rows.withColumn("_latest", latest).where(F.coalesce("version", F.lit(0)) == F.col("_latest")).drop("_latest")


def _register(spark: SparkSession, root: str, rows: list[dict], commit: str) -> None:
    """Append the rows of one commit as the next version of their uid, then look again: if another commit
    took the same version meanwhile, this one is marked as aborted and ValueError is raised. Whoever
    has seen no other may go on, since any later writer sees its rows."""
    uid = rows[0]["uid"]

    def mine(df):
        return df.where(F.col("uid") == uid)

    def append(aborted: bool) -> None:
        full = [{f.name: r.get(f.name) for f in REGISTRY_SCHEMA.fields}
                | {"version": version, "commit": commit, "aborted": aborted} for r in rows]
        spark.createDataFrame(full, REGISTRY_SCHEMA).coalesce(1).write.mode("append").parquet(registry_path(root))

    version = (mine(registry_log(spark, root)).agg(F.max("version")).first()[0] or 0) + 1
    append(aborted=False)
    rival = _committed(mine(registry_log(spark, root))).where((F.col("version") == version) & (F.col("commit") != commit))
    if not rival.isEmpty():
        append(aborted=True)
        raise ValueError(f"dataset {uid!r} was registered by another writer at the same time")


def lineage(spark: SparkSession, root: str, uid: str, max_depth: int = 100) -> DataFrame:
    """The dataset and all its ancestors over ``parent_uid``: ``uid``, ``parent_uid``, ``depth`` (0 for itself) and
    ``n_rows`` (of all its splits). A cycle and a chain beyond ``max_depth`` raise; a parent that is
    not registered is where the chain ends."""
    reg = registry(spark, root).groupBy("uid").agg(F.max("parent_uid").alias("parent_uid"), F.sum("n_rows").alias("n_rows"))
    found = spark.sql("""
        WITH RECURSIVE up MAX RECURSION LEVEL {deep} AS (
          SELECT uid, parent_uid, n_rows, 0 AS depth, array(uid) AS path FROM {reg} WHERE uid = {uid}
          UNION ALL
          SELECT r.uid, r.parent_uid, r.n_rows, up.depth + 1,
                 CASE WHEN array_contains(up.path, r.uid) THEN raise_error(concat('cycle in the lineage at ', r.uid))
                      ELSE concat(up.path, array(r.uid)) END
          FROM up JOIN {reg} r ON r.uid = up.parent_uid)
        SELECT uid, parent_uid, depth, n_rows FROM up""".replace("{deep}", str(int(max_depth))),
                      reg=settle(reg), uid=uid)
    if found.isEmpty():
        raise ValueError(f"no dataset with uid={uid!r} in {root}")
    return found


_JSON_TIME = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}  # to the microsecond, as timestamps are kept


def registry_json(reg: DataFrame) -> DataFrame:
    """Registry rows as JSON documents, ``(uid, split_type, document)``; nulls are left out."""
    return reg.select("uid", "split_type", F.to_json(
        F.struct(*[f.name for f in REGISTRY_SCHEMA.fields]), _JSON_TIME).alias("document"))


def registry_from_json(documents: DataFrame, column: str = "document") -> DataFrame:
    """Typed registry rows from their documents; a malformed document raises."""
    row = F.from_json(column, REGISTRY_SCHEMA, {"mode": "FAILFAST", **_JSON_TIME})
    return documents.select(row.alias("_r")).select("_r.*")


def column_position_map(names: Sequence[str]) -> dict[str, int]:
    """Name -> position, flattening one-element nested lists."""
    flat = []
    for n in names:
        if isinstance(n, (list, tuple)):
            if len(n) != 1:
                raise ValueError(f"nested column entry {n!r} must have one element")
            n = n[0]
        flat.append(n)
    return {n: i for i, n in enumerate(flat)}


def write_dataset(df: DataFrame, root: str, uid: str | None = None, split_col: str | None = SPLIT_COL,
                  fmt: str = "parquet", parent_uid: str | None = None, encoder_uid: str | None = None,
                  params: Mapping | None = None, column_order: Sequence[str] | None = None,
                  class_weight: Mapping[str, float] | None = None,
                  metadata: Mapping[str, str] | None = None) -> str:
    """Write ``df`` (one folder per value of ``split_col`` when present) in a folder of this commit and
    append one registry row per split. ``fmt``: parquet, csv or npz (array bundles). Writing to a
    known ``uid`` makes a new version of it. Returns the dataset uid."""
    spark = df.sparkSession
    uid, commit = uid or new_uid(), uuid.uuid4().hex
    path = os.path.join(root, uid, commit[:12])
    splits_present = split_col and split_col in df.columns
    stored = T.StructType([f for f in df.schema.fields if not splits_present or f.name != split_col])
    if fmt == "npz":  # a bundle has no partition folders of its own
        names = [r[0] for r in df.select(split_col).distinct().collect()] if splits_present else ["all"]
        counts = {}
        for s in names:
            at = os.path.join(path, f"{split_col}={s}") if splits_present else path
            write_npz(df.where(F.col(split_col) == s).drop(split_col) if splits_present else df, at)
            counts[s] = read_npz(spark, at, columns=stored.names[:1]).count()
    else:
        w = df.write.mode("overwrite")
        if splits_present:
            w = w.partitionBy(split_col)
        w.option("header", True).csv(path) if fmt == "csv" else w.parquet(path)
        reread = spark.read.format(fmt).option("header", True).load(path) if fmt == "csv" else spark.read.parquet(path)
        if splits_present:
            counts = {r[split_col]: r["count"] for r in reread.groupBy(split_col).count().collect()}
        else:
            counts = {"all": reread.count()}
    p = dict(params or {})
    order = list(column_order) if column_order is not None else None
    rows = []
    for s, n in sorted(counts.items()):
        rows.append({
            "uid": uid, "parent_uid": parent_uid, "encoder_uid": encoder_uid, "split_type": s,
            "path": os.path.join(path, f"{split_col}={s}") if splits_present else path,
            "format": fmt, "schema": stored.json(), "created": _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None),
            "random_state": p.get("random_state"), "test_size": p.get("test_size"),
            "stratify_variable": p.get("stratify_variable"), "shuffle": p.get("shuffle"),
            "n_rows": int(n), "column_order": order,
            "column_position_map": column_position_map(order) if order else None,
            "class_weight": {str(k): float(v) for k, v in (class_weight or {}).items()} or None,
            "metadata": {str(k): str(v) for k, v in (metadata or {}).items()} or None,
        })
    _register(spark, root, rows, commit)
    return uid


def ingest(df: DataFrame, root: str, key_cols: Sequence[str], test_size: float = 0.2,
           random_state: int = 2025, stratify: str | None = None, shuffle: bool = False,
           order_cols: Sequence[str] | None = None, source: str | None = None, position: str | None = None) -> str:
    """Split (hash-shuffled, stratified, or ordered when ``shuffle`` is off)
    and write train/test with their provenance. Without ``order_cols``, an ordered split goes by the column
    ``position`` (a file position, which is not written) or else by the key."""
    if stratify and not shuffle:
        raise RuntimeError("Stratified train/test split is not implemented for shuffle=False")
    if shuffle:
        tagged = split_shuffled(df, key_cols, test_size, random_state, stratify)
    else:
        tagged = split_ordered(df, list(order_cols or ([position] if position else key_cols)), test_size)
    if position:
        tagged = tagged.drop(position)
    params = {"random_state": random_state, "test_size": test_size,
              "stratify_variable": stratify, "shuffle": shuffle}
    meta = {"data_filepath": source} if source else None
    return write_dataset(tagged, root, params=params, metadata=meta)


def resolve(spark: SparkSession, root: str, uid: str, split_type: str):
    """The latest registry row of (uid, split); a missing one raises ValueError, and so do two of one version."""
    rows = (registry(spark, root).where((F.col("uid") == uid) & (F.col("split_type") == split_type))
            .limit(2).collect())
    if not rows:
        raise ValueError(f"no dataset with uid={uid!r} and split_type={split_type!r} in {root}")
    if len(rows) > 1:
        raise ValueError(f"two writers registered uid={uid!r} and split_type={split_type!r} in {root}")
    return rows[0]


def read_dataset(spark: SparkSession, root: str, uid: str, split_type: str,
                 columns: Sequence[str] | None = None, position: str | None = None) -> DataFrame:
    """Rows of one split; ``columns`` prunes the scan (bundle-style access), ``position`` names a
    column for the row's place in the files."""
    row = resolve(spark, root, uid, split_type)
    if row["format"] == "npz":
        if position:
            raise ValueError("bundles carry no file positions")
        return read_npz(spark, row["path"], columns)
    if row["format"] == "csv":
        df = spark.read.schema(T.StructType.fromJson(json.loads(row["schema"]))).option("header", True) \
            .option("mode", "FAILFAST").csv(row["path"])
    else:
        df = spark.read.parquet(row["path"])
    if position:
        df, columns = file_position(df, position), [*columns, position] if columns else None
    return df.select(*columns) if columns else df


def list_datasets(spark: SparkSession, root: str) -> DataFrame:
    """Every data file under ``root`` with its size and modification time,
    joined to the registry on (uid, split)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.{parquet,csv,npz}").load(root)
             .select("path", "modificationTime", "length"))
    files = files.where(~F.col("path").contains("/_registry/"))
    files = files.withColumn("uid", F.regexp_extract("path", r"/([0-9a-f\-]{36})/", 1)) \
                 .withColumn("split_type", F.regexp_extract("path", r"split_type=([^/]+)/", 1)) \
                 .withColumn("split_type", F.when(F.col("split_type") == "", "all").otherwise(F.col("split_type")))
    reg = registry(spark, root).select("uid", "split_type", "parent_uid", "n_rows")
    return files.join(reg, ["uid", "split_type"], "left")


def clean_metadata(m: Column, prefix: str = META_PREFIX) -> Column:
    """Strip ``prefix`` from the keys that start with it (every occurrence in
    such a key, like a string replace); other keys are kept as they are. When
    two keys become one, the later entry wins."""
    entries = F.transform(F.map_entries(m), lambda e: F.struct(
        F.when(e["key"].startswith(prefix), F.replace(e["key"], F.lit(prefix), F.lit("")))
         .otherwise(e["key"]).alias("key"), e["value"].alias("value")))
    keys = F.transform(entries, lambda e: e["key"])
    last = F.filter(entries, lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), e["key"]))
    return F.map_from_entries(last)


def positions_of(pos_map: Mapping[str, int], variables) -> list[int]:
    """Positions of the named variables (a str or a list); any missing raises."""
    names = [variables] if isinstance(variables, str) else list(variables)
    missing = [v for v in names if v not in pos_map]
    if missing:
        raise ValueError(f"variables {missing} not found in the column position map")
    return [int(pos_map[v]) for v in names]


def registry_positions(spark: SparkSession, root: str, uid: str, split_type: str,
                       variables) -> list[int]:
    row = resolve(spark, root, uid, split_type)
    return positions_of(row["column_position_map"] or {}, variables)


def weights_from_registry(df: DataFrame, root: str, uid: str, label: str,
                          split_type: str = "train", out: str = "sample_weight") -> DataFrame:
    """Per-row sample weight from the class-weight map stored on the resolved
    (uid, split) registry row: ``element_at(map, label)`` (labels as text)."""
    spark = df.sparkSession
    row = resolve(spark, root, uid, split_type)
    weights = row["class_weight"]
    if not weights:
        raise ValueError(f"dataset {uid!r} ({split_type}) has no class weights")
    m = F.create_map(*[x for k, v in sorted(weights.items()) for x in (F.lit(k), F.lit(float(v)))])
    return df.withColumn(out, F.element_at(m, F.col(label).cast("string")))


def parse_and_flatten(text: Column) -> Column:
    """``"a, b,['c']"`` -> ``[a, b, c]``: entries end at commas outside brackets and
    are trimmed; a bracketed entry is a list whose names join the result.
    Blanks and quotes inside names stay, and an empty name is a name."""
    entries = F.regexp_extract_all(F.concat(text, F.lit(",")), F.lit(r"((?:\[[^\]]*\]|[^,\[])*),"), F.lit(1))
    quoted = F.lit(r"('[^']*'|\"[^\"]*\"|[^\[\],'\"\s]+)")
    names = F.transform(entries, lambda x: F.when(
        F.trim(x).startswith("["),
        F.transform(F.regexp_extract_all(x, quoted, F.lit(1)), lambda y: F.regexp_replace(y, r"^(['\"])(.*)\1$", "$2")))
        .otherwise(F.array(F.trim(x))))
    return F.flatten(names)


def save_encoders(encoders: DataFrame, root: str, encoder_uid: str | None = None) -> str:
    """Long encoder table partitioned by variable (one directory each)."""
    encoder_uid = encoder_uid or new_uid()
    encoders.write.mode("overwrite").partitionBy("variable").parquet(os.path.join(root, "encoders", encoder_uid))
    return encoder_uid


def load_encoders(spark: SparkSession, root: str, encoder_uid: str) -> dict[str, DataFrame]:
    """{variable: (value, enc)}; each table reads only its own partition."""
    path = os.path.join(root, "encoders", encoder_uid)
    long = spark.read.parquet(path)
    names = [r["variable"] for r in long.select("variable").distinct().collect()]
    return {v: long.where(F.col("variable") == v).select("value", "enc") for v in sorted(names)}
