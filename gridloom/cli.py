"""Command line: ``python -m gridloom.cli {cut,unfold,preprocess,samples,batches,masks} config.yaml``.

``cut`` and ``unfold`` prepare sources and take a file of their own (box, dates, source names).

Each step is one or a few Spark jobs on the session the command creates (or
the one ``spark-submit`` provides); nothing is collected beyond scalars.
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from .config import LR_MODELS_HINT, load_config, load_settings
from .plans import cuts, preprocess, samples


def _session() -> SparkSession:
    from .session import BASE_CONF
    builder = SparkSession.builder.appName("gridloom")
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="gridloom")
    p.add_argument("step", choices=["cut", "unfold", "preprocess", "samples", "batches", "masks"])
    p.add_argument("config")
    args = p.parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    spark = _session()
    if args.step in ("cut", "unfold"):
        settings = load_settings(args.config)
        (cuts.cut_all if args.step == "cut" else cuts.unfold_all)(spark, settings)
        return
    cfg = load_config(args.config)
    root = cfg.output_path.rstrip("/")
    if args.step == "preprocess":
        preprocess.preprocess(spark, cfg)
    elif args.step == "samples":
        for model in cfg.climate_models:
            f = cfg.spatial.scale_factor if model.name in LR_MODELS_HINT else 1
            ny = (cfg.spatial.y.last_index - cfg.spatial.y.first_index) // f
            nx = (cfg.spatial.x.last_index - cfg.spatial.x.first_index) // f
            for var in model.climate_variables:
                if var.invariant:
                    continue      # invariants have no split to sample
                samples.make_samples(spark, preprocess.split_root(root), f"{root}/samples", ny, nx,
                                     [var.name], [model.name])
    elif args.step == "batches":
        samples.make_batches(spark, f"{root}/samples", f"{root}/batched", cfg.loader.batch_size,
                             cfg.loader.seed, cfg.loader.randomize)
    else:
        # only precipitation has masks, whatever else the configuration holds
        models = [m.name for m in cfg.climate_models if any(v.name == "pr" for v in m.climate_variables)]
        samples.check_mask_variables(["pr"] if models else [v.name for m in cfg.climate_models for v in m.climate_variables])
        samples.make_masks(spark, f"{root}/samples", f"{root}/masks", models=models)


if __name__ == "__main__":
    main()
