"""Command line: the original programs as jobs over a headerless CSV.

    python -m canopy forest-classify --input data.csv --names a,b,c,d,species \\
        --classes setosa,versicolor,virginica --pmml out/model.pmml

Every job reads the file with ``read_points`` (label = last field unless
``--label`` names or numbers another), makes the md5 train / hold-out split,
trains, scores the hold-out part and prints the one-row report as JSON.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from canopy.plans import jobs
from canopy.plans.params import EnsembleSettings
from canopy.session import ensure_checkpoint_dir, ship_package
from canopy.sinks.pmml import ModelMeta, forest_to_pmml, write_pmml
from canopy.sinks.reports import describe_forest, write_report
from canopy.sources.points import read_points

JOBS = ("forest-classify", "forest-regress", "tree-classify", "tree-regress",
        "ensemble-classify", "ensemble-regress", "bagged-forest", "linear")


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="canopy")
    p.add_argument("job", choices=JOBS)
    p.add_argument("--input", required=True, help="file, folder or glob of headerless CSV lines")
    p.add_argument("--names", default=None, help="comma-separated names of every field, in order (default: from --set)")
    p.add_argument("--set", action="append", default=[], metavar="KEY=VALUE",
                   help="an ensemble setting by its original key, e.g. NUM_OF_TREES=7 (repeatable)")
    p.add_argument("--label", default=None, help="label field name or index (default: last)")
    p.add_argument("--mode", default="FAILFAST", choices=("FAILFAST", "PERMISSIVE", "DROPMALFORMED"))
    p.add_argument("--classes", default=None, help="class names for PMML (index order)")
    p.add_argument("--key", default=None, help="fields that name a row (bootstrap and split); default: the whole row, equal rows drawn one by one")
    p.add_argument("--train-frac", type=float, default=None)
    p.add_argument("--trees", type=int, default=3)
    p.add_argument("--attributes", type=int, default=0)
    p.add_argument("--seed", type=int, default=None)
    p.add_argument("--steps", type=int, default=100)
    p.add_argument("--step", type=float, default=0.1)
    p.add_argument("--fit-scaler-on", default="train", choices=("train", "all"))
    p.add_argument("--pmml", default=None, help="write the model as PMML here")
    p.add_argument("--report", default=None, help="write the report as parquet here")
    p.add_argument("--describe", action="store_true", help="print the trees as If/Else text")
    return p


def run(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    a = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"canopy-{a.job}").getOrCreate()
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    settings = EnsembleSettings.from_mapping(dict(x.split("=", 1) for x in a.set))
    if a.names is None and settings.attribute_names is None:
        raise SystemExit("give --names or --set ATTRIBUTE_NAMES=...")
    names = a.names.split(",") if a.names else settings.field_names(len(settings.attribute_names) + 1)
    settings.validate(len(names))
    if a.label is None and settings.label_index is not None:
        a.label = str(settings.label_index)
    if a.classes is None and settings.class_values:
        a.classes = ",".join(settings.class_values)
    a.trees, a.attributes = settings.num_trees or a.trees, settings.num_attributes or a.attributes
    label = int(a.label) if a.label is not None and a.label.isdigit() else a.label
    df = read_points(spark, a.input, names, label, a.mode)
    feats = [c for c in df.columns if c not in ("label", "_corrupt_record")]
    if "_corrupt_record" in df.columns:
        df = df.where("_corrupt_record IS NULL").drop("_corrupt_record")
    regression = a.job.endswith("regress") or a.job == "linear"
    frac = a.train_frac
    if a.job == "forest-classify":
        res = jobs.forest_classification_job(df, feats, trees=a.trees, train_frac=frac or 0.6,
                                             **({"seed": a.seed} if a.seed is not None else {}))
    elif a.job == "forest-regress":
        res = jobs.forest_regression_job(df, feats, trees=a.trees, train_frac=frac or 0.6,
                                         **({"seed": a.seed} if a.seed is not None else {}))
    elif a.job in ("tree-classify", "tree-regress"):
        res = jobs.tree_job(df, feats, task="regression" if regression else "classification",
                            train_frac=frac or 0.6)
    elif a.job in ("ensemble-classify", "ensemble-regress"):
        res = jobs.subspace_ensemble_job(df, feats, task="regression" if regression else "classification",
                                         train_frac=frac or 0.6, trees=a.trees, attributes=a.attributes,
                                         seed=a.seed or 0)
    elif a.job == "bagged-forest":
        from canopy.operators.nodes import predict_classes
        from canopy.functions.metrics import error_rate
        from canopy.operators.splits import hash_split
        from canopy.operators.splitscan import num_classes
        keys = a.key.split(",") if a.key else None
        train, test = hash_split(df, keys or [*feats, "label"], frac or 0.6)
        nodes = jobs.bagged_forest(train, feats, key_cols=keys, trees=a.trees, attributes=a.attributes, seed=a.seed or 0)
        pred = predict_classes(test, nodes, num_classes(df))
        res = jobs.JobResult(nodes, pred, error_rate(pred))
    else:
        res = jobs.linear_regression_job(df, feats, train_frac=frac or 0.9, steps=a.steps, step=a.step,
                                         fit_on=a.fit_scaler_on)
    report = [r.asDict() for r in res.report.collect()]
    out = {"job": a.job, "report": report}
    if res.linear is not None:
        out["weights"] = dict(zip(res.linear.cols, res.linear.weights))
        out["intercept"], out["dropped"] = res.linear.intercept, res.linear.dropped
    print(json.dumps(out, default=str))
    if a.report:
        write_report(res.report, a.report)
    if res.nodes is not None and a.describe:
        for r in describe_forest(res.nodes).orderBy("tree_id", "line_no").toLocalIterator():
            print(f"tree {r['tree_id']}: {r['line']}")
    if res.nodes is not None and a.pmml:
        classes = a.classes.split(",") if a.classes else None
        if not regression and classes is None:
            k = int(res.nodes.agg({"prediction": "max"}).first()[0] or 0) + 1
            classes = [str(float(i)) for i in range(k)]
        label_name = names[-1] if label is None else (names[label] if isinstance(label, int) else label)
        write_pmml(forest_to_pmml(res.nodes, ModelMeta(tuple(feats), label_name,
                                                       None if regression else tuple(classes))), a.pmml)
    return out


def main() -> None:
    run()
