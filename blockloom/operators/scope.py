"""Document state at each line, as window columns over one specification (one exchange and sort by document)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

def order():
    return Window.partitionBy("file_path").orderBy("idx")


def running(flag: Column, until: int = 0) -> Column:
    """Lines with the flag, up to this line (until 0) or the one before (-1)."""
    return F.coalesce(F.sum(F.when(flag, 1).otherwise(0)).over(order().rowsBetween(Window.unboundedPreceding, until)), F.lit(0))


def latest(flag: Column, value: Column, until: int = 0) -> Column:
    """The value at the last line with the flag."""
    return F.last(F.when(flag, value), ignorenulls=True).over(order().rowsBetween(Window.unboundedPreceding, until))


def protect(rows: DataFrame, mode: str) -> DataFrame:
    """In strict mode, lines between fences are plain text; compat leaves all flags as they are."""
    if mode != "strict":
        return rows
    inside = (running(F.col("is_code_fence"), -1) % 2 == 1) & ~F.col("is_code_fence")
    out = rows.withColumn("inside", inside)
    cleared = {c: F.when(F.col("inside"), False).otherwise(F.col(c)) for c in ("is_header", "is_tag", "is_table")}
    return out.withColumns(cleared | {"header_level": F.when(F.col("inside"), 0).otherwise(F.col("header_level"))}).drop("inside")


def inherited(sec: Column, lvl: Column, told: Column, at, until: int = 0) -> list[Column]:
    """For each level, struct (sec, told) of the last row with a `told` at that level: if a section of that level is in force,
    and has any, it is that section's."""
    own = F.struct(sec.alias("sec"), told.alias("told"))
    frame = at.rowsBetween(Window.unboundedPreceding, until)
    return [F.last(F.when(told.isNotNull() & (lvl == n), own), ignorenulls=True).over(frame) for n in range(7)]


def active_tags(rows: DataFrame, tag: Column) -> DataFrame:
    """Adds active: tags of the line's section so far, this line's included, after those of the sections above, by level."""
    at = Window.partitionBy("file_path").orderBy("sec", "idx")
    section = Window.partitionBy("file_path", "sec").orderBy("idx")
    out = rows.withColumn("own", F.collect_list(tag).over(section.rowsBetween(Window.unboundedPreceding, 0)))
    ended = F.lead("idx").over(section).isNull()
    out = out.withColumn("told", F.when(ended & (F.size("own") > 0), F.col("own")))
    out = out.withColumns({f"_t{n}": c for n, c in enumerate(inherited(F.col("sec"), F.col("lvl"), F.col("told"), at, -1))})
    above = [F.when((F.col(f"_t{n}.sec") != F.col("sec")) & F.array_contains("anc", F.col(f"_t{n}.sec").cast("int")), F.col(f"_t{n}.told")) for n in range(7)]
    return out.withColumn("active", F.flatten(F.array_compact(F.array(*above, F.col("own"))))).drop("own", "told", *(f"_t{n}" for n in range(7)))


def headings(rows: DataFrame) -> DataFrame:
    """Adds sec (headers so far), lvl, title and anc (the sections whose tags are in force, 0 first)."""
    head, level, upto = F.col("is_header"), F.col("header_level"), range(1, 7)
    # at level n, the last header of n or above: its text after a mark, or nothing if it is above. One window makes these with sec
    # and lvl, and another, if anc is asked for, the same of sections; plain values, as structs are copied for each line.
    texts = {f"_h{n}": latest(head & (level <= n), F.when(level == n, F.concat(F.lit("#"), F.col("clean_text"))).otherwise("")) for n in upto}
    out = rows.withColumns({"sec": running(head), "lvl": F.coalesce(latest(head, level), F.lit(0))} | texts)
    out = out.withColumns({f"_s{n}": latest(head & (level <= n), F.when(level == n, F.col("sec")).otherwise(-1)) for n in upto})
    text = lambda n: F.when(F.col(f"_h{n}") != "", F.substring(f"_h{n}", 2, 1 << 30))
    section = lambda n: F.when(F.col(f"_s{n}") >= 0, F.col(f"_s{n}").cast("int"))
    title = F.array_join(F.slice(F.array(*(text(n) for n in upto)), F.lit(1), F.col("lvl")), "/", "null")
    anc = F.array_compact(F.slice(F.array(F.lit(0), *(section(n) for n in upto)), F.lit(1), F.col("lvl") + 1))
    return out.withColumns({"title": title, "anc": anc}).drop(*(f"_h{n}" for n in upto), *(f"_s{n}" for n in upto))


def elements(rows: DataFrame) -> DataFrame:
    """Adds the state of code blocks, table runs and the text buffer.

    run_start, run_end (a table run's last line, if lines follow), last (of the file), in_code (before the line), opens,
    closes, gid (line that opened the code block), run_id (line that opened the table run), buf (goes to the text
    buffer), event (flushes the buffer), seg (events so far), buf_before (the buffer has rows at an event).
    """
    table = F.col("is_table")
    out = rows.withColumns({"prev_table": F.coalesce(F.lag("is_table").over(order()), F.lit(False)), "next_table": F.lead("is_table").over(order())})
    out = out.withColumns({"run_start": table & ~F.col("prev_table"), "run_end": table & F.coalesce(~F.col("next_table"), F.lit(False)), "last": F.col("next_table").isNull(), "fences": running(F.col("is_code_fence"), -1)})
    # the end of a table run clears the code state, so fences are counted from the last one
    out = out.withColumn("since", F.coalesce(latest(F.col("run_end"), F.col("fences"), -1), F.lit(0)))
    out = out.withColumn("in_code", (F.col("fences") - F.col("since")) % 2 == 1)
    plain = ~(F.col("is_header") | F.col("is_tag") | F.col("is_code_fence") | table)
    out = out.withColumns({"opens": F.col("is_code_fence") & ~F.col("in_code"), "closes": F.col("is_code_fence") & F.col("in_code"), "plain": plain, "buf": F.col("is_header") | (plain & ~F.col("in_code"))})
    out = out.withColumn("event", F.col("is_header") | F.col("opens") | F.col("run_start")).withColumn("bufs", running(F.col("buf"), -1))
    out = out.withColumns({"seg": running(F.col("event")), "gid": latest(F.col("opens"), F.col("idx")), "run_id": latest(F.col("run_start"), F.col("idx")), "event_bufs": F.coalesce(latest(F.col("event"), F.col("bufs"), -1), F.lit(0))})
    return out.withColumn("buf_before", F.col("event") & (F.col("bufs") > F.col("event_bufs"))).drop("prev_table", "next_table", "fences", "since", "bufs", "event_bufs")
