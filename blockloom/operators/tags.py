"""Tag parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from blockloom.config import ParserOptions
from blockloom.functions.text import let, strip

TAG_TYPE = "struct<key:string,value:string,original_text:string>"


def parse_tag(text: Column, options: ParserOptions = ParserOptions()) -> Column:
    """Struct (key, value, original_text), or null for what is no tag or is excluded.

    `#<prefix>x` becomes `#seed/x`; the first / parts key and value; without one the key is `topic`. Exclusion patterns
    are anchored at the start and see the converted text.
    """

    def parts(raw: Column) -> Column:
        body = F.split(F.substring(raw, 2, 1 << 30), "/", 2)
        out = lambda p: F.struct(
            F.when(F.size(p) > 1, F.get(p, F.lit(0))).otherwise("topic").alias("key"),
            F.when(F.size(p) > 1, F.get(p, F.lit(1))).otherwise(F.get(p, F.lit(0))).alias("value"), raw.alias("original_text"),
        )
        excluded = F.lit(False)
        for pattern in options.exclude:
            excluded = excluded | raw.rlike(f"^(?:{pattern})")
        return F.when(raw.startswith("#") & ~excluded, let(body, out))

    seeded = lambda raw: F.when(raw.startswith("#" + options.tag_prefix), F.concat(F.lit("#seed/"), F.substring(raw, 3, 1 << 30))).otherwise(raw)
    return let(let(strip(text), seeded), parts)


def provenance(path: Column, title: Column) -> Column:
    """The file_path tag, and the title tag where there is a title."""
    tag = lambda key, value: F.struct(F.lit(key).alias("key"), value.alias("value"), F.concat(F.lit(f"#{key}/"), value).alias("original_text"))
    return F.when(title != "", F.array(tag("file_path", path), tag("title", title))).otherwise(F.array(tag("file_path", path)))
