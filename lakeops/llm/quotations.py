"""Quotations linked to the messages they come from, and conversations in reply order without quotes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.operators.windows import ordered_window
from lakeops.session import written

# Lines that announce a quotation.
ANNOUNCED = r"^(?:On|Am|Le|El) .+(?:wrote|schrieb.*|a écrit|escribió) ?:\s*$"
#: A single line is linked by itself only if it has this many characters.
LINE_CHARS = 20


def passages(body: Column) -> Column:
    """Runs of lines of one quote level, in order: array of (level, text, raw), ``raw`` with its quote marks. ``> >`` and
    ``>>`` both are level 2."""
    plain = F.regexp_replace(F.coalesce(body, F.lit("")), r"\r\n?", "\n")
    lines = F.split(F.regexp_replace(plain, r"(?m)(?:^|\G)[ \t]*>", ">"), "\n")

    def of(lines: Column) -> Column:
        levels = F.transform(lines, lambda line: F.length(F.regexp_extract(line, "^(>*)", 1)))
        places = F.sequence(F.lit(0), F.size(lines) - 1)

        def runs(levels: Column) -> Column:
            starts = F.filter(places, lambda i: (i == 0) | (F.get(levels, i) != F.coalesce(F.get(levels, i - 1), F.lit(-1))))

            def run(starts: Column) -> Column:
                def one(start: Column, k: Column) -> Column:
                    end = F.coalesce(F.get(starts, k + 1), F.size(lines))
                    run = F.slice(lines, start + 1, end - start)
                    inside = F.transform(run, lambda line: F.regexp_replace(line, "^>+ ?", ""))
                    return F.struct(
                        F.get(levels, start).alias("level"),
                        F.array_join(inside, "\n").alias("text"),
                        F.array_join(run, "\n").alias("raw"),
                    )

                return F.transform(starts, one)

            return F.get(F.transform(F.array(starts), run), 0)

        return F.get(F.transform(F.array(levels), runs), 0)

    # Lambdas over one element hold what is used more than once.
    return F.get(F.transform(F.array(lines), of), 0)


def _unannounced(text: Column) -> Column:
    """A passage without the announcement it ends with, and without blank lines after that."""
    lines = F.split(F.regexp_replace(text, r"\s+$", ""), "\n")
    announced = F.regexp_replace(F.element_at(lines, -1), "^>+ ?", "").rlike(ANNOUNCED)
    return F.when(announced, F.array_join(F.slice(lines, F.lit(1), F.size(lines) - 1), "\n")).otherwise(text)


def without_quotes(found: Column, linked: Column) -> Column:
    """What a message says itself: all of it but what is linked to another message, and the announcement directly before
    that. ``linked`` has, for each run of lines with a link, its number, whether it is linked as a whole, and else the
    hashes of its linked lines. A quotation of something that is not there stays, with its marks, as does a line that
    only looks like an announcement. Runs of nothing but marks and blank ends go."""
    links = F.coalesce(linked, F.array().cast("array<struct<passage:int,whole:boolean,lines:array<bigint>>>"))

    def kept(run: Column, number: Column) -> Column:
        link = F.get(F.filter(links, lambda one: one["passage"] == number), 0)
        lines = F.split(run["raw"], "\n")
        rest = F.filter(lines, lambda line: ~F.array_contains(link["lines"], line_hash(F.regexp_replace(line, "^>+ ?", ""))))
        own = (
            F.when(run["level"] == 0, run["text"])
            .when(link.isNull(), run["raw"])
            .when(~link["whole"], F.array_join(rest, "\n"))
            .otherwise("")
        )
        announces = F.exists(links, lambda one: one["passage"] == number + 1)
        bare = F.when(announces, _unannounced(own)).otherwise(own)
        return F.when(bare.rlike(r"[^>\s]") | (run["level"] == 0), bare)

    runs = F.filter(F.transform(found, kept), lambda text: text.isNotNull())
    return F.regexp_replace(F.array_join(runs, "\n"), r"^\s+|\s+$", "")


def line_hash(line: Column) -> Column:
    return F.xxhash64(normalised(line))


def own_text(found: Column) -> Column:
    """Level 0 without announcements and blank ends: what others quote of a message as a whole."""
    mine = F.transform(F.filter(found, lambda p: p["level"] == 0), lambda p: p["text"])
    lines = F.filter(F.split(F.array_join(mine, "\n"), "\n"), lambda line: ~line.rlike(ANNOUNCED))
    return F.regexp_replace(F.array_join(lines, "\n"), r"^\s+|\s+$", "")


def normalised(text: Column) -> Column:
    """Lower case, any white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def _units(texts: Column) -> Column:
    """What can be quoted of some passages, as (rank, text): whole passages first, then single longer lines."""
    whole = F.transform(texts, lambda t: F.struct(F.lit(0).alias("rank"), normalised(t).alias("text")))
    lines = F.flatten(F.transform(texts, lambda t: F.split(t, "\n")))
    single = F.transform(lines, lambda t: F.struct(F.lit(1).alias("rank"), normalised(t).alias("text")))
    return F.filter(
        F.array_distinct(F.concat(whole, single)),
        lambda u: (u["text"] != "") & ((u["rank"] == 0) | (F.length(u["text"]) >= LINE_CHARS)),
    )


def _hashed(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"h1": F.xxhash64("unit.text"), "h2": F.xxhash64(F.lit("b"), "unit.text")})


def link_quotes(parsed: DataFrame) -> DataFrame:
    """Every linked quotation: ``msg_id``, ``level``, the message ``source`` it comes from, and ``link``: the number of its
    run of lines, whether all of that is linked, and the hashes of the lines that are.

    A quoted passage belongs to the latest earlier message of the same ``thread`` that says the same itself, by the hash
    of the normalised text; where no message has the passage as a whole, to one that has a line of it. The count of
    originals up to each quotation names the one it belongs to, so a text that thousands of messages share is neither
    gathered in one task nor paired with all who quote it.
    """
    mine = F.array_distinct(
        F.concat(F.array("own"), F.transform(F.filter("found", lambda p: p["level"] == 0), lambda p: p["text"]))
    )
    originals = _hashed(parsed.select("thread", "sent", "msg_id", F.explode(_units(mine)).alias("unit"))).select(
        "thread", "sent", "msg_id", "h1", "h2", F.lit(1).alias("is_original"), F.lit(None).cast("int").alias("level"),
        F.lit(None).cast("int").alias("passage"), F.lit(None).cast("int").alias("rank"),
    ).dropDuplicates(["thread", "msg_id", "h1", "h2"])
    quoted = parsed.select("thread", "sent", "msg_id", F.posexplode("found").alias("passage", "p")).filter("p.level > 0")
    quoted = _hashed(quoted.select("*", F.explode(_units(F.array("p.text"))).alias("unit"))).select(
        "thread", "sent", "msg_id", "h1", "h2", F.lit(0).alias("is_original"), F.col("p.level").alias("level"), "passage",
        F.col("unit.rank").alias("rank"),
    )
    # A message's quotations come before its own text in the order, so it never quotes itself.
    order = ["sent", "msg_id", "is_original", "passage", "rank"]
    keys = ["thread", "h1", "h2"]
    units = written(originals.union(quoted), "quotable")
    counted = written(ordered_window(units, order, keys, running={"k": "is_original"}, sample_every=16), "quotations")
    named = counted.filter("is_original = 1").select(*keys, "k", F.col("msg_id").alias("source"), F.col("sent").alias("source_sent"))
    # Of a run that no message has as a whole, the lines that some message has are its links.
    met = counted.filter("is_original = 0 AND k > 0").alias("q").join(
        named.alias("o"), F.expr("q.thread <=> o.thread AND q.h1 = o.h1 AND q.h2 = o.h2 AND q.k = o.k")
    )
    best = F.max(F.struct((-F.col("rank")).alias("whole"), "source_sent", "source")).alias("best")
    lines = F.collect_set(F.when(F.col("rank") == 1, F.col("q.h1"))).alias("lines")  # of one run of one message
    return met.groupBy("q.msg_id", "level", "passage").agg(best, lines).select(
        "msg_id",
        "level",
        F.col("best.source").alias("source"),
        F.col("best.source_sent").alias("source_sent"),
        F.struct("passage", (F.col("best.whole") == 0).alias("whole"), "lines").alias("link"),
    )


def _threads(replies: DataFrame) -> DataFrame:
    """``msg_id``, ``root`` and ``depth`` of ``replies`` (msg_id, reply_to) by pointer jumping: each round doubles the way
    that is known, so a chain of n replies takes log2(n) rounds. A message takes part until its way ends at a root."""
    first = replies.select(
        "msg_id", F.col("reply_to").alias("up"), F.lit(1).alias("way"), F.col("reply_to").isNull().alias("ended")
    )
    first = written(first, "reply-ways")
    finished, going = [first.filter("ended")], first.filter("NOT ended")
    while not going.isEmpty():
        above = reduce(DataFrame.union, [*finished, going]).select(
            F.col("msg_id").alias("up"), F.col("up").alias("next"), F.col("way").alias("more"), F.col("ended").alias("known")
        )
        at_root = F.col("next").isNull()
        step = going.drop("ended").join(above, "up").select(
            "msg_id",
            F.coalesce("next", "up").alias("up"),
            (F.col("way") + F.when(at_root, 0).otherwise(F.col("more"))).alias("way"),
            F.col("known").alias("ended"),
        )
        step = written(step, "reply-ways")
        finished.append(step.filter("ended"))
        going = step.filter("NOT ended")
    return reduce(DataFrame.union, finished).select(
        "msg_id",
        F.coalesce("up", "msg_id").alias("root"),
        F.when(F.col("up").isNull(), 0).otherwise(F.col("way")).alias("depth"),
    )


def reply_ordered(messages: DataFrame) -> DataFrame:
    """Conversations of ``messages`` (msg_id, thread, sent, body), one row per message, in reply order without quotes.

    Rows: ``msg_id``, ``thread``, ``sent``, ``own`` (the text without linked quotations; what is quoted from nowhere and
    what only looks like an announcement stays), ``n_linked`` quotations, ``reply_to`` (the
    source of the shallowest linked quotation, the latest of several), ``root``, ``depth`` below it, and ``position`` in
    the conversation by depth, time and id. A null body says nothing, a message without a linked quotation begins a
    conversation, a null thread is one thread, a null time comes last. Repeated ids are one message (the smallest body);
    null ids are left out. An empty table gives an empty result.
    """
    one = messages.filter("msg_id IS NOT NULL").groupBy("msg_id").agg(
        F.min(F.struct("thread", "sent", F.coalesce("body", F.lit("")).alias("body"))).alias("m")
    )
    found = one.select("msg_id", "m.thread", "m.sent", passages(F.col("m.body")).alias("found"))
    parsed = written(found.withColumn("own", own_text(F.col("found"))), "messages-parsed")
    links = written(link_quotes(parsed), "quotation-links")
    nearest = F.max(F.struct((-F.col("level")).alias("up"), "source_sent", "source")).alias("best")
    replies = links.groupBy("msg_id").agg(
        nearest, F.count("*").alias("n_linked"), F.collect_list("link").alias("linked")  # of one message
    ).select("msg_id", F.col("best.source").alias("reply_to"), "n_linked", "linked")
    replies = written(
        parsed.select("msg_id", "thread", "sent").join(replies, "msg_id", "left").fillna(0, ["n_linked"]), "replies"
    )
    placed = written(replies.join(_threads(replies), "msg_id"), "threads")
    numbered = ordered_window(placed, ["depth", "sent", "msg_id"], ["root"], row_number="position", sample_every=16)
    said = parsed.select("msg_id", "found")
    return numbered.join(said, "msg_id").withColumn("own", without_quotes(F.col("found"), F.col("linked"))).drop("found", "linked")


def quoting_messages(turns: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, text) as messages that quote the turn before, and in it the one before that."""
    one = turns.groupBy("conv_id", "turn").agg(F.min(F.struct("text", "role")).alias("t"))
    one = one.select("conv_id", "turn", F.coalesce("t.text", F.lit("")).alias("text"), F.col("t.role").alias("role"))

    def earlier(back: int) -> DataFrame:
        return one.select("conv_id", (F.col("turn") + back).alias("turn"), F.col("text").alias(f"text_{back}"))

    def quoted(back: int) -> Column:
        text = F.col(f"text_{back}")
        return F.when(F.trim(text) != "", F.regexp_replace(text, "(?m)^", "> " * back))

    joined = one.join(earlier(1), ["conv_id", "turn"], "left").join(earlier(2), ["conv_id", "turn"], "left")
    second = F.when(quoted(1).isNotNull(), quoted(2))
    return joined.select(
        F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("-")), F.coalesce(F.col("turn").cast("string"), F.lit("-"))).alias("msg_id"),
        F.col("conv_id").alias("thread"),
        F.col("turn").alias("sent"),
        F.concat_ws("\n", second, quoted(1), F.col("text")).alias("body"),
    )
