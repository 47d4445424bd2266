"""Lines of documents and their classification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockloom import runtime
from blockloom.functions import text as T
from blockloom.operators import folds


#: Input (files, as stored, and rows of tables, which may be stored in very few bytes) for each partition of documents: their
#: lines and states are many times as large, and are sorted.
SPREAD_BYTES, SPREAD_ROWS = 4 << 20, 1 << 16


def spread(docs: DataFrame, ordered: bool = True) -> DataFrame:
    """docs exchanged by file_path, so that their lines, which are many times as large, need no further exchange; and in its order,
    so that the lines are made in the order in which they are sorted next, if they are."""
    spark = docs.sparkSession
    few = min(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    many = max(few, -(-runtime.input_bytes(docs) // SPREAD_BYTES), -(-runtime.input_rows(docs) // SPREAD_ROWS))
    out = docs.repartition(many, "file_path")
    return out.sortWithinPartitions("file_path") if ordered else out


def lines(docs: DataFrame) -> DataFrame:
    """file_path, idx (0-based), text (with its newline) of every line; a final newline gives no empty last line."""
    split = F.split(T.universal_newlines(F.coalesce(F.col("text"), F.lit(""))), "\n")
    each = docs.select("file_path", split.alias("parts")).select("file_path", F.size("parts").alias("n"), F.posexplode("parts").alias("idx", "part"))
    last = F.col("idx") == F.col("n") - 1
    return each.filter(~(last & (F.col("part") == ""))).select("file_path", "idx", F.when(last, F.col("part")).otherwise(F.concat("part", F.lit("\n"))).alias("text"))


#: Kinds of lines. What every match of a pattern has is looked for before the pattern, as patterns that know Unicode are slow.
def fenced(text: Column) -> Column:
    return (text.contains("```") | text.contains("~~~")) & text.rlike(T.FENCE)


def headed(stripped: Column) -> Column:
    return stripped.startswith("#") & stripped.rlike(T.HEADER)


def tagged(stripped: Column) -> Column:
    return stripped.startswith("#") & stripped.rlike(T.TAG)


def barred(stripped: Column) -> Column:
    return stripped.startswith("|") & stripped.rlike(T.TABLE)


def level(stripped: Column) -> Column:
    return F.char_length(F.regexp_extract(stripped, T.HEADER, 1))


def heading(stripped: Column) -> Column:
    return T.strip(F.regexp_extract(stripped, T.HEADER, 2))


def classify(rows: DataFrame) -> DataFrame:
    """Adds clean_text, is_code_fence, is_header, header_level, is_tag, is_table; a fence is nothing else, nor a header."""
    out, stripped = rows.withColumn("stripped", T.strip_line(F.col("text"))), F.col("stripped")
    plain = ~F.col("is_code_fence") & ~F.col("is_header")
    return (
        out.withColumn("is_code_fence", fenced(F.col("text")))
        .withColumn("is_header", ~F.col("is_code_fence") & headed(stripped))
        .withColumns(
            {
                "header_level": F.when(F.col("is_header"), level(stripped)).otherwise(0),
                "clean_text": F.when(F.col("is_header"), heading(stripped)).otherwise(stripped),
                "is_tag": plain & tagged(stripped),
                "is_table": plain & barred(stripped),
            }
        )
        .select("file_path", "idx", "text", "clean_text", "is_header", "header_level", "is_tag", "is_code_fence", "is_table")
    )


PLAIN, FENCE, HEADER, TAG, TABLE = range(5)
#: Printable ASCII that no other line begins with; white space may stand before what makes one.
_PLAIN_FIRST = [c for c in range(33, 127) if chr(c) not in "#|`~"]


def runs(docs: DataFrame) -> DataFrame:
    """Adds runs to docs: array of structs (idx, end, kind, level, line, size, texts) of each run of table lines or of plain lines, and of each
    other line: first and last line, a header's level and text, a tag's text, characters (not of tables) and lines. The kinds are those that classify gives the lines. Documents have far
    fewer runs than lines, and what is in force at a line is so at all lines of its run.

    Each step is a projection of its own, as lambdas copy what they give.
    """
    by_pattern = lambda x: T.let(T.strip_line(x), lambda s: F.when(fenced(x), FENCE).when(headed(s), HEADER).when(tagged(s), TAG).when(barred(s), TABLE).otherwise(PLAIN))
    # a line's first character mostly tells that it is plain, or its ends that it is of a table
    told = lambda x: F.when(x.startswith("|") & x.endswith("|\n") & (x != "|\n"), TABLE).when(F.ascii(x).isin(_PLAIN_FIRST), PLAIN).otherwise(by_pattern(x))
    out = docs.select("file_path", F.split(T.universal_newlines(F.coalesce(F.col("text"), F.lit(""))), "(?<=\\n)").alias("texts"))
    # what follows a final newline is no line
    out = out.withColumn("texts", F.when(F.element_at("texts", -1) == "", F.slice("texts", 1, F.size("texts") - 1)).otherwise(F.col("texts")))
    out = out.withColumn("kinds", F.transform("texts", told))
    kind = lambda i: F.get("kinds", i)
    joins = lambda i: (i > 0) & kind(i).isin(PLAIN, TABLE) & (kind(i) == kind(i - 1))
    out = out.withColumn("starts", F.filter(folds.upto(F.size("kinds")), lambda i: ~joins(i)))
    ends = lambda j: F.coalesce(F.get("starts", j + 1), F.size("kinds"))
    texts = lambda a, j: F.slice("texts", a + 1, ends(j) - a)

    def run(a: Column, j: Column) -> Column:
        line, size = T.strip_line(F.get("texts", a)), F.char_length(F.array_join(texts(a, j), ""))
        own = {"idx": a, "end": ends(j) - 1, "kind": kind(a), "level": F.when(kind(a) == HEADER, level(line)), "line": F.when(kind(a) == HEADER, heading(line)).when(kind(a) == TAG, line)}
        return F.struct(*(c.alias(n) for n, c in own.items()), F.when(kind(a) != TABLE, size).alias("size"), texts(a, j).alias("texts"))

    return out.select("file_path", F.transform("starts", run).alias("runs"))


def kind() -> Column:
    return F.when(F.col("is_code_fence"), "fence").when(F.col("is_header"), "header").when(F.col("is_tag"), "tag").when(F.col("is_table"), "table").otherwise("text")
