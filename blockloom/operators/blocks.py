"""Blocks: text pieces and protected elements with their tags, flags, ids and line ranges.

The input is scanned once and exchanged once, by file_path, as whole documents. A document is then one row: an array of its runs
of lines, and one fold over it that gives its units (what flushes the text buffer, code blocks, tables) with the headings, tags and
cuts in force. Units are rows, and their pieces. No join, no union, no window but the one that numbers blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from blockloom.config import ParserOptions
from blockloom.functions import text as T
from blockloom.operators import folds, rows, tags


#: Roles of a unit.
SEGMENT, CODE, TABLE = "segment", "code", "table"
TAGS, UNIT = f"array<struct<idx:int,lvl:int,tag:{tags.TAG_TYPE}>>", f"struct<role:string,flush:int,title:string,tags:array<struct<idx:int,lvl:int,tag:{tags.TAG_TYPE}>>,split:boolean,at:array<int>>"
#: A document's state: texts of the headings in force (its size is the level), tags in force, whether something has cut the
#: section, whether code is open, the runs of the code block and of the text buffer, the buffer's characters and whether it has more
#: than a heading; units of the last STEPS runs, and of those before. Arrays that grow are copied, so units are kept in two levels.
STATE = {"heads": "array<string>", "tags": TAGS, "cut": "boolean", "in_code": "boolean", "code": "array<int>", "buf": "array<int>", "size": "long", "more": "boolean", "out": f"array<{UNIT}>", "done": f"array<array<{UNIT}>>"}
STEPS = 256


def _state(s: Column | None = None, **new: Column) -> Column:
    """s with new values; the first state without s."""
    first = lambda kind: F.array().cast(kind) if kind.startswith("array") else F.lit(0 if kind == "long" else False).cast(kind)
    return F.struct(*(((new[n].cast(kind) if kind == "long" else new[n]) if n in new else first(kind) if s is None else s[n]).alias(n) for n, kind in STATE.items()))


def found(runs: Column, options: ParserOptions) -> Column:
    """Units of a document's runs: role, flush (line of the flush), title and tags in force there, split (a header or an element
    or an overflow has cut its section), at (its runs).

    A header inside code emits the block so far without ending it; a table inside code takes the block's place, and what
    the block had is lost; at the end of the file an open element is emitted.
    """
    none, yes, no = F.array().cast("array<int>"), F.lit(True), F.lit(False)

    def unit(s: Column, role: str, flush: Column, split: Column, at: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), flush.cast("int").alias("flush"), F.array_join(s["heads"], "/", "null").alias("title"), s["tags"].alias("tags"), split.alias("split"), at.alias("at"))

    some = lambda flag, value: F.when(flag, F.array(value)).otherwise(F.array().cast(f"array<{UNIT}>"))
    full = lambda s: F.size(s["buf"]) > 0
    # a piece overflows if the buffer is too long, unless all of it is one heading
    over = lambda s: s["more"] & (s["size"] > options.max_chars)
    text = lambda s, flush, split: some(full(s), unit(s, SEGMENT, flush, split, s["buf"]))

    def step(s: Column, i: Column) -> Column:
        run, own = F.get(runs, i), F.array(i)
        kind, line = run["kind"], run["line"]
        if options.mode == "strict":
            kind = F.when(s["in_code"] & (kind != rows.FENCE), rows.PLAIN).otherwise(kind)
        begins, cut, more = kind == rows.FENCE, s["cut"] | over(s), i < F.size(runs) - 1
        code = some(s["in_code"], unit(s, CODE, run["idx"], cut, s["code"]))
        level = run["level"]
        kept = F.slice(s["heads"], F.lit(1), level - 1)
        heads = F.when(level == 1, F.array(line)).otherwise(F.concat(kept, F.array_repeat(F.lit(None).cast("string"), level - 1 - F.size(kept)), F.array(line)))
        tag = F.struct(run["idx"].alias("idx"), F.size(s["heads"]).alias("lvl"), tags.parse_tag(line, options).alias("tag"))
        left = F.when(full(s) | s["in_code"], F.concat(s["out"], text(s, run["idx"], cut), code)).otherwise(s["out"])
        header = _state(s, heads=heads, tags=F.filter(s["tags"], lambda t: t["lvl"] < level), cut=no, buf=own, size=run["size"], more=no, out=left)
        ended = {"buf": none, "size": F.lit(0), "more": no}
        opens = _state(s, cut=cut | full(s), in_code=yes, code=own, out=F.concat(s["out"], text(s, run["idx"], yes)), **ended)
        closes = _state(s, cut=yes, in_code=no, code=none, out=F.concat(s["out"], F.array(unit(s, CODE, run["idx"], yes, F.concat(s["code"], own)))))
        halts = cut | full(s) | more
        table = unit(s, TABLE, run["end"] + F.when(more, 0).otherwise(1), halts, own)
        tabled = _state(s, cut=halts, in_code=no, code=none, out=F.concat(s["out"], text(s, run["idx"], yes), F.array(table)), **ended)
        plain = F.when(s["in_code"], _state(s, code=F.concat(s["code"], own))).otherwise(_state(s, buf=F.concat(s["buf"], own), size=s["size"] + run["size"], more=yes))
        tagged = _state(s, tags=F.concat(s["tags"], F.filter(F.array(tag), lambda t: t["tag"].isNotNull())))
        return F.when(kind == rows.HEADER, header).when(kind == rows.TAG, tagged).when(begins & ~s["in_code"], opens).when(begins, closes).when(kind == rows.TABLE, tabled).otherwise(plain)

    def steps(s: Column, a: Column) -> Column:
        some_runs = F.sequence(a, F.least(a + STEPS, F.size(runs)) - 1)
        return F.aggregate(some_runs, _state(s, out=F.array().cast(STATE["out"])), step, lambda t: _state(t, done=F.concat(s["done"], F.array(t["out"]))))

    def finish(s: Column) -> Column:
        flush, cut = F.get(runs, F.size(runs) - 1)["end"] + 1, s["cut"] | over(s)
        return F.flatten(F.concat(s["done"], F.array(text(s, flush, cut), some(s["in_code"], unit(s, CODE, flush, cut, s["code"])))))

    places = F.when(F.size(runs) > 0, F.sequence(F.lit(0), F.size(runs) - 1, F.lit(STEPS))).otherwise(none)
    return F.aggregate(places, _state(), steps, finish)


def states(docs: DataFrame, options: ParserOptions = ParserOptions()) -> DataFrame:
    """A row per unit of each document: file_path, what `found` tells, and runs, those of the unit."""
    out = rows.runs(rows.spread(docs, ordered=False))
    out = out.withColumn("units", found(F.col("runs"), options))
    part = lambda i: F.struct(F.get("runs", i)["idx"].alias("idx"), F.get("runs", i)["texts"].alias("texts"), (F.get("runs", i)["kind"] == rows.HEADER).alias("head"))
    named = ("role", "flush", "title", "tags", "split")
    whole = F.transform("units", lambda u: F.struct(*(u[n].alias(n) for n in named), F.transform(u["at"], part).alias("runs")))
    return folds.each(out, ("file_path",), whole, "j", "u").select("file_path", "u.*")


def row(idx: Column, text: Column, head: Column) -> Column:
    return F.struct(idx.alias("idx"), F.char_length(text).alias("len"), head.alias("head"), (T.strip_line(text) == "").alias("blank"), text.alias("text"))


def segments(lines: DataFrame) -> DataFrame:
    """From lines with their state, one row per buffer segment that has rows: file_path, seg and its rows in order."""
    each = row(F.col("idx"), F.col("text"), F.col("is_header"))
    return lines.filter("buf").groupBy("file_path", F.col("seg").cast("long").alias("seg")).agg(F.sort_array(F.collect_list(each)).alias("rows"))


def trimmed(rows: Column) -> Column:
    """Rows without leading and trailing blank ones: struct (start, end, content)."""
    full = F.filter(rows, lambda r: ~r["blank"])["idx"]
    # blank rows at the ends are stripped with the text
    return F.when(F.exists(rows, lambda r: ~r["blank"]), F.struct(F.array_min(full).alias("start"), F.array_max(full).alias("end"), T.strip_line(F.array_join(rows["text"], "")).alias("content")))


def blocks(docs: DataFrame, options: ParserOptions = ParserOptions()) -> DataFrame:
    """file_path, block_seq, block_id, content, start_line, end_line, tags, is_splited, protected_element_type,
    protected_element_overlength of every block."""
    is_text, runs, own = F.col("role") == SEGMENT, F.col("runs"), F.col("rows")
    lines = F.flatten(F.transform(runs, lambda r: F.transform(r["texts"], lambda t, i: row(r["idx"] + i, t, r["head"]))))
    last = F.element_at(runs, -1)
    element = F.struct(F.get(runs, F.lit(0))["idx"].alias("start"), (last["idx"] + F.size(last["texts"]) - 1).alias("end"), F.array_join(F.flatten(runs["texts"]), "").alias("text"))
    each = states(docs, options).withColumns({"rows": F.when(is_text, lines), "element": F.when(~is_text, element)}).drop("runs")
    # text has pieces, another unit is whole; a piece is split if one of its segment overflowed
    pieces = F.when(is_text, folds.text_pieces(own, options.max_chars)).otherwise(F.array(F.lit(None).cast(folds.PIECE)))
    each = folds.each(each, ("file_path", "role", "title", "tags", "flush", "split", "rows", "element"), pieces, "sub", "p")
    piece = F.slice(own, F.col("p.a") + 1, F.col("p.b") - F.col("p.a") + 1)
    flush = F.when(F.col("p.over"), F.get(own, F.col("p.b"))["idx"]).otherwise(F.col("flush"))
    cut = F.col("split") | F.coalesce(F.col("p.over"), F.lit(False)) | (F.col("sub") > 0)
    each = each.select("file_path", "role", "title", "tags", "sub", flush.alias("flush"), cut.alias("split"), "element", piece.alias("rows"))
    whole = F.struct("element.start", "element.end", T.strip_line(F.col("element.text")).alias("content"))
    each = each.select("file_path", "role", "title", "tags", "sub", "flush", "split", F.when(is_text, trimmed(own)).otherwise(whole).alias("t"), F.char_length("element.text").alias("size"))
    kind, start, end, content = F.when(~is_text, F.col("role")), F.col("t.start"), F.col("t.end"), F.col("t.content")
    every = each.filter(F.col("t").isNotNull() & (content != "") & (~is_text | ~T.heading_only(content)))
    active = F.concat(F.filter("tags", lambda t: t["idx"] < F.col("flush"))["tag"], tags.provenance(F.col("file_path"), F.col("title")))
    shift = F.when(is_text, 0).otherwise(1)
    whole = every.select(
        "file_path", "flush", F.when(is_text, 1).otherwise(0).alias("rank"), "sub", kind.alias("kind"), content.alias("content"), (start + 1).alias("first"), (end + 1).alias("last"), active.alias("tags"), "split",
        (~is_text & (F.col("size") > options.max_chars)).alias("long"), T.block_id(F.col("file_path"), start + shift, end + shift, content).alias("id"),
    )
    parts = F.when(F.col("long"), folds.chunks(F.col("kind"), F.col("content"), options.max_chars)).otherwise(F.array("content"))
    each = folds.each(whole.withColumn("parts", parts), ("*", F.size("parts").alias("n")), "parts", "i", "part")
    number = (F.col("i") + 1).cast("string")
    start, end = folds.chunk_lines(F.col("first"), F.col("last"), F.col("content"), F.col("part"), F.col("i"), F.col("n"))
    order = Window.partitionBy("file_path").orderBy("flush", "rank", "sub", "first", "i")
    return each.select(
        "file_path", F.row_number().over(order).alias("block_seq"),
        F.when(F.col("long"), F.concat("id", F.lit("_"), F.lpad(number, F.greatest(F.lit(3), F.char_length(number)), "0"))).otherwise(F.col("id")).alias("block_id"),
        F.col("part").alias("content"), start.alias("start_line"), end.alias("end_line"), "tags", (F.col("split") | F.col("long")).alias("is_splited"),
        F.col("kind").alias("protected_element_type"), F.lit(False).alias("protected_element_overlength"),
    )
