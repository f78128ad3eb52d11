"""Run a job: ``python -m labelgap <job> --help``; on a cluster pass this file to ``spark-submit``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from labelgap import plans
from labelgap.sources import read_first_existing, read_label_json, read_parquet
from labelgap.streaming import score_line_stream


def _preprocess(spark, args):
    plans.preprocess(read_first_existing(spark, args.input), plans.Config(output=args.output, scaler=args.scaler))


def _preprocess_chain(spark, args):
    done = plans.preprocess_chain(read_first_existing(spark, args.input), args.output, plans.Config(scaler=args.scaler))
    plans.stage_report(spark, done).show(truncate=False)


def _gap(spark, args):
    gap = plans.gap_analysis(read_first_existing(spark, args.input), plans.Config(output=args.output))
    for name, table in plans.gap_tables(gap).items():
        table.write.mode("overwrite").csv(f"{args.output}/gap_{name}", header=True)


def _merge(spark, args):
    plans.merge_nutrients(read_parquet(spark, args.gap), read_parquet(spark, args.preprocessed), plans.Config(output=args.output))


def _labels_of(spark, args):
    return read_parquet(spark, args.gap) if args.gap else None


def _detect(spark, args):
    config = plans.Config(output=args.output, n_synthetic=args.rows)
    result = plans.synthesis_and_detector(read_first_existing(spark, args.input), _labels_of(spark, args), config)
    result["model"].write().overwrite().save(f"{args.output}/detector")
    for name in ("quality", "importance"):
        result[name].write.mode("overwrite").csv(f"{args.output}/{name}", header=True)


def _effect(spark, args):
    table = plans.effect_of_augmentation(read_first_existing(spark, args.input), _labels_of(spark, args))
    table.write.mode("overwrite").csv(f"{args.output}/augmentation_effect", header=True)


def _score(spark, args):
    model = plans.detector_model(read_first_existing(spark, args.input), _labels_of(spark, args))
    plans.risk_scores(model, read_parquet(spark, args.products)).write.mode("overwrite").parquet(f"{args.output}/scores")


def _score_lines(spark, args):
    model = plans.detector_model(read_first_existing(spark, args.input), _labels_of(spark, args))
    query = score_line_stream(spark, args.lines, model, f"{args.output}/scored", f"{args.output}/rejected", args.checkpoint)
    query.awaitTermination()


def _validate(spark, args):
    plans.validate(read_parquet(spark, args.original), read_parquet(spark, args.synthetic), config=plans.Config(output=args.output))


def _draft(spark, args):
    plans.draft_labels(read_parquet(spark, args.gap), read_parquet(spark, args.preprocessed), config=plans.Config(output=args.output))


def _report(spark, args):
    plans.report_labels(read_label_json(spark, args.labels), plans.Config(output=args.output))


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="labelgap")
    jobs = parser.add_subparsers(required=True)

    def job(name, run, about, **options):
        command = jobs.add_parser(name, help=about)
        command.set_defaults(run=run)
        command.add_argument("--output", required=True, help="folder to write to")
        for option, settings in options.items():
            command.add_argument(f"--{option}", **settings)

    path, paths = {"required": True}, {"required": True, "nargs": "+", "help": "candidate paths, the first that exists is read"}
    labels = {"help": "gap table, needed if the input lacks the language case"}
    job("preprocess", _preprocess, "products to train and test tables", input=paths, scaler={"default": "standard"})
    job("preprocess-chain", _preprocess_chain, "the same in stages, on from the last whole one", input=paths, scaler={"default": "standard"})
    job("gap", _gap, "language case and gap per category", input=paths)
    job("merge", _merge, "nutrients joined to the gap table", gap=path, preprocessed=path)
    job("detect", _detect, "synthetic rows and risk detector", input=paths, gap=labels, rows={"type": int, "default": 3000})
    job("effect", _effect, "does augmentation help the detector", input=paths, gap=labels)
    job("score", _score, "risk of products", input=paths, gap=labels, products=path)
    job("score-lines", _score_lines, "risk of lines of numbers in a folder, those that came since the last run", input=paths, gap=labels, lines=path, checkpoint=path)
    job("validate", _validate, "synthetic against original rows", original=path, synthetic=path)
    job("draft-labels", _draft, "label drafts for gap products", gap=path, preprocessed=path)
    job("report-labels", _report, "flat table and cards of labels", labels=path)
    return parser


def main(arguments: list[str] | None = None) -> None:
    args = _parser().parse_args(arguments)
    args.run(SparkSession.builder.appName("labelgap").getOrCreate(), args)


if __name__ == "__main__":
    main()
