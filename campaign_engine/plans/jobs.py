"""Job entry points: ``python -m campaign_engine.plans.jobs <stage> ...`` (or
spark-submit this file). Each stage reads and writes through the dataset
registry under ``--store``:

* ``ingest``     CSV -> split -> train/test datasets + provenance
* ``preprocess`` derive CPA/CPC/convert, fit encoders on train, embed,
                 assemble features for both splits (encoders saved by uid)
* ``train``      cross-validated model training, train/test scores, model,
                 metrics and run record
* ``augment``    append P(convert) from a saved classifier to a features dataset
* ``train_two_stage``  fit and save classifier, regressor, encoders and CPC record
* ``recommend``  two-stage scoring of the top-k configurations per request, with
                 a saved model (``--model_uri``) or one fitted on the train split
"""

from __future__ import annotations

import argparse
import json
import os
from functools import partial

from pyspark.sql import functions as F

from ..operators import configure as cfg
from ..operators import encoders as enc
from ..operators import features as feat
from ..operators import evaluate, metrics, models, scoring, splits, stats
from ..operators.embed import EmbeddingMemo, embed_distinct, hashing_embedder
from ..schema import CATEGORICAL_FEATURES
from ..session import get_spark, materialize
from ..sources import datasets as ds


def _embedder(spark, args):
    if getattr(args, "embedding_table", None):
        return spark.read.parquet(args.embedding_table)  # (value, embedding)
    model = hashing_embedder(args.embedding_dim)
    if getattr(args, "embedding_memo", None):  # vectors of earlier jobs; the model runs for new values only
        return EmbeddingMemo(args.embedding_memo, model)
    return model


def ingest(spark, args) -> str:
    order = getattr(args, "order_columns", None)
    position = None if args.shuffle or order else "_position"  # an unshuffled split keeps the order of the file
    keys = {k: getattr(args, k, None) for k in ("access_key", "secret_key", "endpoint")}
    scan = partial(ds.scan_csv_store, **keys) if "://" in args.data_path and not args.data_path.startswith("file:") else ds.scan_csv
    df = scan(spark, args.data_path, position=position)
    return ds.ingest(df, args.store, getattr(args, "key_columns", ["campaign_id"]), args.test_size, args.random_state,
                     args.stratify_variable, args.shuffle, order_cols=order, source=args.data_path, position=position)


def preprocess(spark, args) -> str:
    train = metrics.derive_all(ds.read_dataset(spark, args.store, args.dataset_uid, "train"))
    test = metrics.derive_all(ds.read_dataset(spark, args.store, args.dataset_uid, "test"))
    kind = "frequency" if args.encoder_type == "frequency_encoding" else "target"
    encoders = enc.fit_encoders(train, args.categorical_features, kind,
                                target=args.target_variable if kind == "target" else None,
                                stat=args.stats_to_compute)
    encoder_uid = ds.save_encoders(encoders, args.store)
    weights = feat.class_weights(train, args.categorical_target)
    emb = _embedder(spark, args)
    both = train.withColumn("split_type", F.lit("train")).unionByName(test.withColumn("split_type", F.lit("test")))
    texts = getattr(args, "features_to_embed", ["industry"])
    out = feat.preprocess(both, encoders, emb, label=args.categorical_target,
                          categorical=args.categorical_features, numeric=args.numeric_features,
                          text=texts, weights=weights)
    blocks = [f"{t}_embedding" for t in texts]
    first = out.select(*[F.size(b).alias(b) for b in blocks]).first()
    names = feat.feature_names(enc.encoded_names(args.categorical_features) + list(args.numeric_features),
                               blocks, first.asDict())
    cw = {str(r[args.categorical_target]): r["class_weight"] for r in weights.collect()}
    uid = ds.write_dataset(out.select("campaign_id", "CPA", "convert", "sample_weight", "features", "split_type"),
                           args.store, parent_uid=args.dataset_uid, encoder_uid=encoder_uid,
                           column_order=names, class_weight=cw)
    return uid


def train(spark, args) -> str:
    tr = ds.read_dataset(spark, args.store, args.dataset_uid, "train", position="_position").withColumnRenamed("campaign_id", "id")
    te = ds.read_dataset(spark, args.store, args.dataset_uid, "test").withColumnRenamed("campaign_id", "id")
    kind = models.kind_of(args.model_type)
    if args.predictor_variables:
        row = ds.resolve(spark, args.store, args.dataset_uid, "train")
        wanted = predictor_names(args.predictor_variables)
        tr = feat.select_by_name(tr, wanted, row["column_order"])
        te = feat.select_by_name(te, wanted, row["column_order"])
    # like the usual cross-validation: stratified folds for classes, contiguous ones (in file order) for numbers
    if args.cv > 1 and kind == "classifier":
        tr = materialize(splits.cv_folds_stratified(tr, ["id"], args.target_variable, args.cv, 2025), "folds")
    elif args.cv > 1:
        tr = materialize(splits.cv_folds_contiguous(tr, ["id"], args.cv, order_cols=["_position"]), "folds")
    tr = tr.drop("_position")
    positive = 1 if kind == "classifier" else None
    weight = None
    if args.include_sample_weight:  # the train split's class weights, as registered
        tr = ds.weights_from_registry(tr.drop("sample_weight"), args.store, args.dataset_uid,
                                      args.target_variable)
        weight = "sample_weight"
    model, cv = models.train_cv(args.model_type, tr, args.target_variable, args.cv, scoring=args.scoring,
                                weight=weight, positive=positive)
    cv = materialize(cv, "cv-metrics")
    metric = args.evaluation_metric
    tr_s = models.evaluate(model, tr, args.target_variable, metric, positive)
    te_s = models.evaluate(model, te, args.target_variable, metric, positive)
    for name, value in result_metrics(cv, getattr(args, "model_result_metrics", [])):
        print(f"{name}: {value:.5f}")
    path = os.path.join(args.store, "models", args.save_model_as)
    models.save_model(model, path)
    run_id = models.log_run(spark, args.store, args.model_type, {"cv": args.cv, "scoring": args.scoring},
                            tr_s, te_s, path, tr.schema.simpleString())
    models.save_metrics(cv, args.store, run_id)
    models.cv_document(cv).coalesce(1).write.mode("overwrite").text(f"{path}_metrics")  # the same scores as one JSON text
    return run_id


def predictor_names(items) -> list[str]:
    """Flags like ``CPC`` and ``['industry_embedding']`` to plain names."""
    out = []
    for item in items:
        item = item.strip()
        if item.startswith("[") and item.endswith("]"):
            out += [p.strip().strip("'\"") for p in item[1:-1].split(",") if p.strip()]
        else:
            out.append(item)
    return out


def result_metrics(cv, names) -> list[tuple[str, float]]:
    """Means of CV scores asked for as ``test_accuracy``, ``train_f1``, ...; a score
    that the CV results lack raises ValueError (with cv = 1 there are none)."""
    means = {f"{r['split']}_{r['metric']}": r["mean"] for r in evaluate.cv_mean(cv).collect()}
    if not means:
        return []
    if bad := [n for n in names or [] if n not in means]:
        raise ValueError(f"{bad} not in the CV results; available: {sorted(means)}")
    return [(n, means[n]) for n in names or []]


def augment(spark, args) -> str:
    model = models.load_model(spark, args.model_uri)
    rows = ds.read_dataset(spark, args.store, args.dataset_uid, "train").withColumn("split_type", F.lit("train")) \
        .unionByName(ds.read_dataset(spark, args.store, args.dataset_uid, "test").withColumn("split_type", F.lit("test")))
    pred = model.predict(rows.withColumnRenamed("campaign_id", "id")) \
        .withColumn("conversion_probability", F.col("probability").cast("double"))
    out = pred.withColumn("features", F.concat("features", F.array("conversion_probability")))
    order = ds.resolve(spark, args.store, args.dataset_uid, "train")["column_order"] or []
    given = {k: v for k, v in vars(args).items() if v is not None and "secret" not in k and "access" not in k} | {"stage": "augment"}
    uid = ds.write_dataset(out.select(F.col("id").alias("campaign_id"), "CPA", "convert", "features", "split_type"),
                           args.store, parent_uid=args.dataset_uid,
                           column_order=list(order) + ["conversion_probability"], metadata=given)
    return uid


def _vectors(spark, args, rows):
    """The embedding table of the rows' industries (a saved model needs a table)."""
    if args.embedding_table:
        return spark.read.parquet(args.embedding_table)
    values = rows.select(F.coalesce("industry", F.lit("")).alias("value")).union(
        spark.createDataFrame([("",)], "value string")).distinct()
    return materialize(embed_distinct(values, "value", hashing_embedder(args.embedding_dim), "embedding"), "embedding-map")


def train_two_stage(spark, args) -> str:
    rows = metrics.derive_all(ds.read_dataset(spark, args.store, args.dataset_uid, "train"))
    model = scoring.fit_two_stage(rows, _vectors(spark, args, rows))
    path = os.path.join(args.store, "models", args.save_model_as)
    scoring.save_two_stage(model, path)
    return path


def recommend(spark, args) -> str:
    train_rows = metrics.derive_all(ds.read_dataset(spark, args.store, args.dataset_uid, "train"))
    model = scoring.load_two_stage(spark, args.model_uri) if args.model_uri else \
        scoring.fit_two_stage(train_rows, _embedder(spark, args))
    top = cfg.top_k_configs(stats.config_usage(train_rows), args.top_k)
    reqs = spark.read.parquet(args.requests)
    cands = cfg.candidate_space(reqs, top).withColumn(
        "campaign_id", F.concat_ws("|", "request_id", "market_id", "publisher"))
    best = cfg.recommend(scoring.predict(model, cands), ["request_id"])
    best.write.mode("overwrite").parquet(args.output)
    return args.output


STAGES = {"ingest": ingest, "preprocess": preprocess, "train": train, "augment": augment,
          "train_two_stage": train_two_stage, "recommend": recommend}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="campaign_engine.plans.jobs")
    p.add_argument("stage", choices=sorted(STAGES))
    p.add_argument("--store", required=True)
    p.add_argument("--master", default=None)
    p.add_argument("--data_path")
    p.add_argument("--access_key", default=None)
    p.add_argument("--secret_key", default=None)
    p.add_argument("--endpoint", default=None)
    p.add_argument("--test_size", type=float, default=0.2)
    p.add_argument("--random_state", type=int, default=2025)
    p.add_argument("--stratify_variable", default=None)
    p.add_argument("--shuffle", action="store_true")
    p.add_argument("--key_columns", nargs="+", default=["campaign_id"])
    p.add_argument("--order_columns", nargs="+", default=None)
    p.add_argument("--features_to_embed", nargs="+", default=["industry"])
    p.add_argument("--model_result_metrics", nargs="*", default=[])
    p.add_argument("--dataset_uid")
    p.add_argument("--categorical_features", nargs="+", default=CATEGORICAL_FEATURES)
    p.add_argument("--numeric_features", nargs="+", default=["CPC"])
    p.add_argument("--target_variable", default="convert")
    p.add_argument("--categorical_target", default="convert")
    p.add_argument("--encoder_type", default="frequency_encoding",
                   choices=["frequency_encoding", "target_encoding"])
    p.add_argument("--stats_to_compute", default="mean")
    p.add_argument("--embedding_table", default=None)
    p.add_argument("--embedding_memo", default=None)
    p.add_argument("--embedding_dim", type=int, default=64)
    p.add_argument("--model_type", default="KNeighborsClassifier")
    p.add_argument("--scoring", nargs="+", default=["accuracy", "precision", "recall", "f1"])
    p.add_argument("--evaluation_metric", default="accuracy")
    p.add_argument("--save_model_as", default="conversion_classifier")
    p.add_argument("--cv", type=int, default=20)
    p.add_argument("--include_sample_weight", action="store_true")
    p.add_argument("--predictor_variables", nargs="*", default=None)
    p.add_argument("--model_uri")
    p.add_argument("--requests")
    p.add_argument("--output")
    p.add_argument("--top_k", type=int, default=20)
    return p


def main(argv=None) -> None:
    args = parser().parse_args(argv)
    spark = get_spark(args.master)
    result = STAGES[args.stage](spark, args)
    print(json.dumps({"stage": args.stage, "result": result}))


if __name__ == "__main__":
    main()

