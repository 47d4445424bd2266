"""Greedy packing folds, as JVM aggregate() expressions that gather break positions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockloom.functions.text import let, strip

PIECE = "struct<a:int,b:int,over:boolean>"


def each(df: DataFrame, keep: tuple, parts: str | Column, *names: str) -> DataFrame:
    """The kept columns with each element of parts and its place before it. A plain posexplode would have the optimizer ask, in a
    filter of its own, whether parts has any, which computes it twice more."""
    return df.select(*keep, F.posexplode_outer(parts).alias(*names)).filter(F.col(names[0]).isNotNull())


def upto(n: Column) -> Column:
    """0..n-1, empty for n = 0."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _piece(a: Column, b: Column, over: bool) -> Column:
    return F.struct(a.cast("int").alias("a"), b.cast("int").alias("b"), F.lit(over).alias("over"))


def text_pieces(rows: Column, max_chars: int) -> Column:
    """Pieces (a, b, over) of a segment's rows (structs with len, head, blank), by 0-based inclusive ordinals.

    The row that passes the limit ends its piece and starts the next one. A row that is alone too long ends its piece,
    stands alone if something stood before it, and does not start the next.
    """
    state = F.struct(F.lit(0).cast("long").alias("acc"), F.lit(0).alias("start"), F.array().cast(f"array<{PIECE}>").alias("out"))

    def step(s: Column, j: Column) -> Column:
        size = F.get(rows, j)["len"].cast("long")
        long, start, out = size > max_chars, s["start"], s["out"]
        full = ~F.get(rows, j)["head"] & (s["acc"] + size > max_chars)
        before = F.exists(F.slice(rows, start + 1, j - start), lambda r: ~r["blank"])
        closed = F.concat(out, F.array(_piece(start, j, True)))
        alone = F.when(long & before, F.concat(closed, F.array(_piece(j, j, True)))).otherwise(closed)
        next_start, next_acc = F.when(long, j + 1).otherwise(j), F.when(long, F.lit(0).cast("long")).otherwise(size)
        return F.when(full, F.struct(next_acc.alias("acc"), next_start.alias("start"), alone.alias("out"))).otherwise(F.struct((s["acc"] + size).alias("acc"), start.alias("start"), out.alias("out")))

    def finish(s: Column) -> Column:
        n = F.size(rows)
        return F.when(s["start"] < n, F.concat(s["out"], F.array(_piece(s["start"], n - 1, False)))).otherwise(s["out"])

    # rows that fit together are one piece
    fits = F.aggregate(rows["len"], F.lit(0).cast("long"), lambda n, size: n + size) <= max_chars
    return F.when(fits & (F.size(rows) > 0), F.array(_piece(F.lit(0), F.size(rows) - 1, False))).otherwise(F.aggregate(upto(F.size(rows)), state, step, finish))


def _breaks(lines: Column, first: int, head: Column, max_chars: int) -> Column:
    """Ordinals (from `first`) at which a new chunk starts; `head` is the length each chunk starts with."""
    state = F.struct(head.cast("long").alias("acc"), F.lit(0).alias("n"), F.array().cast("array<int>").alias("out"))

    def step(s: Column, j: Column) -> Column:
        cost = (F.char_length(F.get(lines, j)) + 1).cast("long")
        full = (s["n"] > 0) & (s["acc"] + cost > max_chars)
        return F.when(full, F.struct((head + cost).cast("long").alias("acc"), F.lit(1).alias("n"), F.concat(s["out"], F.array(j)).alias("out"))).otherwise(F.struct((s["acc"] + cost).alias("acc"), (s["n"] + 1).alias("n"), s["out"].alias("out")))

    places = F.when(F.size(lines) > first, F.sequence(F.lit(first), F.size(lines) - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(places, state, step, lambda s: s["out"])


def _cut(lines: Column, first: int, breaks: Column) -> Column:
    """The lines from `first` on as one array per chunk."""
    parts = lambda starts: F.transform(starts, lambda a, i: F.slice(lines, a + 1, F.coalesce(F.get(starts, i + 1), F.size(lines)) - a))
    return let(F.concat(F.array(F.lit(first)), breaks), parts)


def code_chunks(content: Column, max_chars: int) -> Column:
    """Chunks of whole lines; a line that is too long stands alone."""
    return let(F.split(content, "\n"), lambda x: let(_breaks(x, 0, F.lit(0), max_chars), lambda b: F.transform(_cut(x, 0, b), lambda c: F.array_join(c, "\n"))))


def table_chunks(content: Column, max_chars: int) -> Column:
    """Chunks of whole rows, each after the table's first two lines; a chunk has one row at least, if there are any."""

    def cut(x: Column) -> Column:
        head = F.char_length(F.get(x, F.lit(0))) + F.char_length(F.get(x, F.lit(1))) + 2
        rows = lambda b: F.transform(_cut(x, 2, b), lambda c: F.array_join(F.concat(F.slice(x, 1, 2), c), "\n"))
        return F.when(F.size(x) <= 2, F.array(F.array_join(x, "\n"))).otherwise(let(_breaks(x, 2, head, max_chars), rows))

    return let(F.split(content, "\n"), cut)


def generic_chunks(content: Column, max_chars: int) -> Column:
    """Windows of max_chars characters, cut back to the last newline, else the last space, beyond 70 % of the window.

    One pass of a pattern, as each match begins where the last one ended: the rest, if it fits; else the longest window that
    such a mark follows; else a whole window.
    """
    least = int(max_chars * 0.7) + 1
    back = [f".{{{least},{max_chars - 1}}}(?={mark})" for mark in (r"\n", " ")] if least < max_chars else []
    window = "(?s)" + "|".join([f".{{1,{max_chars}}}\\z", *back, f".{{{max_chars}}}"])
    parts = F.filter(F.transform(F.regexp_extract_all(content, F.lit(window), F.lit(0)), strip), lambda p: p != "")
    return F.when(F.char_length(content) <= max_chars, F.array(content)).otherwise(parts)


def chunks(kind: Column, content: Column, max_chars: int) -> Column:
    return F.when(kind == "code", code_chunks(content, max_chars)).when(kind == "table", table_chunks(content, max_chars)).otherwise(generic_chunks(content, max_chars))


def chunk_lines(start: Column, end: Column, content: Column, chunk: Column, i: Column, n: Column) -> tuple[Column, Column]:
    """Estimated first and last line of chunk i of n, in proportion to its characters."""
    total = end - start + 1
    share = F.greatest(F.lit(1), (total * (F.char_length(chunk) / F.char_length(content))).cast("int"))
    first = start + ((total - share) * i / n).cast("int")
    last = F.when(i == n - 1, end).otherwise(first + share - 1)
    return F.when(n == 1, start).otherwise(first), F.when(n == 1, end).otherwise(last)


def request_ids(tokens: Column, most_texts: int, most_tokens: int) -> Column:
    """0-based request number of each text of a batch, from the texts' token estimates in order."""
    state = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("acc"), F.lit(-1).alias("req"), F.array().cast("array<int>").alias("out"))

    def step(s: Column, t: Column) -> Column:
        make = lambda n, acc, req: F.struct(n.alias("n"), acc.cast("long").alias("acc"), req.alias("req"), F.concat(s["out"], F.array(req)).alias("out"))
        new = (s["n"] == 0) | (s["n"] >= most_texts) | (s["acc"] + t > most_tokens)
        return F.when(t > most_tokens, make(F.lit(0), F.lit(0), s["req"] + 1)).when(new, make(F.lit(1), t, s["req"] + 1)).otherwise(make(s["n"] + 1, s["acc"] + t, s["req"]))

    return F.aggregate(tokens, state, step, lambda s: s["out"])
