"""Command line: indicators of one modality below a folder, as documents."""

from __future__ import annotations

import argparse


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="loomspan")
    p.add_argument("modality", choices=["eye-tracking", "keyboard", "touch", "voice"])
    p.add_argument("base_path", nargs="?", help="folder of date/client/task/modality/archive/file, or with --single one recording")
    p.add_argument("--base_path", "--root_dir", dest="root", help="base_path as an option; --root_dir is its older name")
    p.add_argument("--single", action="store_true", help="base_path is one recording; its client and task are --client_id and --context")
    p.add_argument("--client_id", default="unknown_client")
    p.add_argument("--context", default="unknown_task")
    p.add_argument("--output_base_path", "--output_root", dest="output_root", help="default: primitive_indicator beside base_path")
    p.add_argument("--clients", "--only_client_id", dest="clients", nargs="*")
    p.add_argument("--window_size_sec", type=float, default=60.0)
    p.add_argument("--stride_sec", type=float, default=30.0)
    p.add_argument("--screen_width_px", type=float, default=1440.0)
    p.add_argument("--screen_height_px", type=float, default=900.0)
    p.add_argument("--timezone", default="Asia/Seoul")
    p.add_argument("--pause_threshold_ms", type=float, default=2000.0)
    p.add_argument("--ngram_n", type=int, default=2)
    p.add_argument("--holdtime_mode", default="paired_rows", choices=["paired_rows", "event_pairing", "auto"])
    return p


def main(argv: list[str] | None = None) -> int:
    p = parser()
    a = p.parse_args(argv)
    base = a.base_path or a.root
    if not base or (a.base_path and a.root):
        p.error("give one base_path")
    from pyspark.sql import SparkSession

    from loomspan.plans import batch, document
    from loomspan.plans.config import PIConfig

    spark = SparkSession.builder.appName("loomspan").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    cfg = PIConfig(a.window_size_sec, a.stride_sec, a.screen_width_px, a.screen_height_px, a.timezone, a.pause_threshold_ms, a.ngram_n, a.holdtime_mode)
    root = batch.output_root(base, a.output_root, a.single)
    if a.single:
        n = document.write_documents(batch.run_file(spark, base, a.modality, cfg, a.client_id, a.context).documents, root, a.modality)
    else:
        n = batch.run_and_write(spark, base, a.modality, cfg, a.clients, root)
    print(f"{n} documents in {root}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
