"""python -m blockloom [--dir DIR | FILE...] [--no-json] [--no-vectorize] [--config FILE]"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from blockloom import config
from blockloom.operators.embed import RemoteProvider
from blockloom.plans import pipeline


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="blockloom", description="Markdown to tagged blocks to vectors")
    p.add_argument("files", nargs="*")
    p.add_argument("--dir")
    p.add_argument("--no-json", action="store_true")
    p.add_argument("--no-vectorize", action="store_true")
    p.add_argument("--config", default="config.yaml")
    a = p.parse_args(argv)
    parser, vector = config.load(a.config) if os.path.exists(a.config) else (config.ParserOptions(), config.VectorOptions())
    spark = SparkSession.builder.appName("blockloom").getOrCreate()
    if a.files and not a.dir:
        parsed = pipeline.process_files(spark, *a.files, options=parser)
    else:
        parsed = pipeline.process_directory(spark, a.dir, parser)
    if not a.no_json:
        print(pipeline.write_json_array(parsed, parser.output_dir))
    if not a.no_vectorize:
        factory = (lambda: RemoteProvider(vector)) if vector.api_base or vector.api_key else None
        saved = pipeline.save(spark, parsed, vector, factory=factory, limited=factory is not None)
        saved.summary.show(truncate=False)
        pipeline.preview(parsed).show(truncate=False, vertical=True)


if __name__ == "__main__":
    main()
