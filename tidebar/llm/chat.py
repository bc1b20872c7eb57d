"""Chat formatting by linking quotations, in DataFrame functions alone.

Lines that begin with > are quoted, nested as deep as they have such marks.
Runs of lines of one level are passages; a quoted passage is normalised, hashed
and joined to the earliest message of its conversation that says the same in
its own words, as a whole, a run, a line, or, for a passage of several lines, some lines
in a row (found by sums of hashes of words, see print_of()). A message answers the original of its least nested linked quotation
(the latest of these), and a thread is what answers lead back to one message.
Quotations are left out of the result.

A thread is a conversation: it has a key of its own (conversation), and its messages have
places in reply order, a message before its answers and these depth first, in the order of
turns. Conversations read in the order thread_turn, place; without quotations each
message is the first of its own thread, and the order is that of turns.

A null or empty text says nothing. Messages with a null conv_id or turn link to nothing and
have no place but the first. Repeated rows all stay, with the same place each; a passage that
several messages say goes to the earliest. A long text is split into lines, whose number counts once for each length of a
quotation that its conversation looks for. No
rows give none; columns of any other name play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: The marks before a quoted line.
MARKS = r"^[ \t]*(?:>[ \t]?)+"
#: That a text has a quoted line.
QUOTED = r"(?:^|[\r\n])[ \t]*>"
MOST_ROUNDS = 60


def _lines(text: Column) -> Column:
    return F.split(F.regexp_replace(F.coalesce(text, F.lit("")), "\r\n?", "\n"), "\n", -1)


def _level(line: Column) -> Column:
    return F.char_length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), "[^>]", ""))


def passages(text: Column) -> Column:
    """array<struct<level, text>>: the runs of lines of one quotation level, without their marks."""
    lines = F.transform(_lines(text), lambda line: F.struct(_level(line).alias("level"), F.regexp_replace(line, MARKS, "").alias("text")))

    def runs(rows: Column) -> Column:
        n = F.size(rows)
        starts = F.filter(F.sequence(F.lit(1), n), lambda i: (i == 1) | (F.element_at(rows, i)["level"] != F.element_at(rows, F.greatest(i - 1, F.lit(1)))["level"]))
        cuts = lambda s: F.transform(
            F.sequence(F.lit(1), F.size(s)),
            lambda k: F.struct(F.element_at(s, k).alias("from"), F.coalesce(F.try_element_at(s, k + 1), n + 1).alias("to")),
        )
        return F.flatten(
            F.transform(
                F.array(starts),
                lambda s: F.transform(
                    cuts(s),
                    lambda c: F.struct(
                        F.element_at(rows, c["from"])["level"].alias("level"),
                        F.array_join(F.transform(F.slice(rows, c["from"], c["to"] - c["from"]), lambda r: r["text"]), "\n").alias("text"),
                    ),
                ),
            )
        )

    # bound as variables, so that the lines are split once a row
    return F.flatten(F.transform(F.array(lines), runs))


def own_words(text: Column) -> Column:
    """The text without quoted lines, trimmed."""
    kept = F.filter(_lines(text), lambda line: ~line.rlike(MARKS))
    return F.when(text.rlike(QUOTED), F.trim(F.array_join(kept, "\n"), F.lit(" \n\t"))).otherwise(F.coalesce(text, F.lit("")))


def digest(passage: Column) -> Column:
    """The hash of a passage with its white space and case made equal."""
    return F.sha2(F.lower(F.trim(F.regexp_replace(passage, r"\s+", " "))), 256)


#: Primes below 2 ** 31, so that products fit a long, and a base for each.
PRIMES = ((2147483647, 911382323), (2147483629, 972663749), (2147483587, 690690697))
#: Bits of the number of words of a message.
WORD_BITS = 31


def _power(base: int, prime: int, exponent: Column) -> Column:
    """base ** exponent modulo the prime, by squares made beforehand."""
    squares = F.array(*(F.struct(F.lit(b).alias("bit"), F.lit(pow(base, 1 << b, prime)).cast("long").alias("value")) for b in range(WORD_BITS)))
    bit = lambda s: F.bit_get(exponent, s["bit"]) == 1
    return F.aggregate(F.filter(squares, bit), F.lit(1).cast("long"), lambda acc, s: acc * s["value"] % F.lit(prime))


def _words(text: Column) -> Column:
    """The words of a passage, as its digest has them."""
    return F.filter(F.split(F.lower(F.regexp_replace(text, r"\s+", " ")), " "), lambda w: w != "")


def print_of(text: Column) -> Column:
    """struct<words, h0, h1, h2>: the number of words of a passage, and their sum in powers of a base by place, modulo each prime.

    Prints of texts one after another add up to that of the whole, and from the sums up to two places comes that of what is between.
    """
    start = F.struct(F.lit(0).cast("long").alias("words"), *(x for k in range(len(PRIMES)) for x in (F.lit(0).cast("long").alias(f"h{k}"), F.lit(1).cast("long").alias(f"p{k}"))))

    def add(acc: Column, word: Column) -> Column:
        own = F.xxhash64(word)
        parts = [(acc["words"] + 1).alias("words")]
        for k, (prime, base) in enumerate(PRIMES):
            parts += [((acc[f"h{k}"] + F.pmod(own, F.lit(prime)) * acc[f"p{k}"]) % F.lit(prime)).alias(f"h{k}"), (acc[f"p{k}"] * F.lit(base) % F.lit(prime)).alias(f"p{k}")]
        return F.struct(*parts)

    return F.aggregate(_words(text), start, add, lambda acc: F.struct(acc["words"].alias("words"), *(acc[f"h{k}"].alias(f"h{k}") for k in range(len(PRIMES)))))


def quotations(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, level, lines, hash, print) of each quoted passage that has words; print: of passages of several lines."""
    some = messages.where(F.col("text").rlike(QUOTED) & F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    each = some.select("conv_id", "turn", F.explode(passages(F.col("text"))).alias("p")).where("p.level > 0")
    lines = F.size(F.split("p.text", "\n", -1))
    return (
        each.where(F.col("p.text").rlike(r"\S"))
        .select("conv_id", "turn", F.col("p.level").alias("level"), lines.alias("lines"), digest(F.col("p.text")).alias("hash"), F.when(lines > 1, print_of(F.col("p.text"))).alias("print"))
        .distinct()
    )


def _first(passages: DataFrame) -> DataFrame:
    """(conv_id, hash, said): the first turn of each passage; passages: conv_id, turn, passage."""
    said = passages.where(F.col("passage").rlike(r"\S"))
    return said.groupBy("conv_id", digest(F.col("passage")).alias("hash")).agg(F.min("turn").alias("said"))


def originals(messages: DataFrame) -> DataFrame:
    """(conv_id, hash, said): the first turn that says the passage in its own words."""
    own = F.filter(passages(F.col("text")), lambda p: p["level"] == 0)
    runs = F.transform(own, lambda p: p["text"])
    said = F.array_distinct(F.concat(F.array(own_words(F.col("text"))), runs, F.flatten(F.transform(runs, lambda r: F.split(r, "\n")))))
    return _first(messages.select("conv_id", "turn", F.explode(said).alias("passage")))


def lines_in_a_row(messages: DataFrame, lengths: DataFrame) -> DataFrame:
    """(conv_id, lines, print, said): the first turn that says a passage in so many of its own lines in a row; lengths: conv_id, lines, the numbers of lines that are asked for.

    A message's lines are rows with the print of all that stands before each (a running sum), so that the print of any
    lines in a row is a difference of two. Nothing is put together but for the rows of a start and an end: one for each line and
    number of lines that its conversation asks for.
    """
    own = F.filter(_lines(F.col("text")), lambda line: ~line.rlike(MARKS))
    asked = messages.join(lengths.select("conv_id").distinct(), "conv_id", "left_semi")
    # rows of one conversation and turn are told apart by their text; one more line marks the end
    each = asked.select("conv_id", "turn", F.xxhash64("text").alias("m"), F.posexplode(F.concat(own, F.array(F.lit("")))).alias("i", "line"))
    each = each.select("conv_id", "turn", "m", "i", print_of(F.col("line")).alias("p")).dropDuplicates(["conv_id", "turn", "m", "i"])
    before = Window.partitionBy("conv_id", "turn", "m").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    placed = each.withColumn("words", F.coalesce(F.sum("p.words").over(before), F.lit(0).cast("long")))
    for k, (prime, base) in enumerate(PRIMES):
        placed = placed.withColumn(f"t{k}", F.col(f"p.h{k}") * _power(base, prime, F.col("words")) % F.lit(prime))
    sums = {f"s{k}": F.coalesce(F.sum(f"t{k}").over(before), F.lit(0).cast("long")) % F.lit(prime) for k, (prime, _) in enumerate(PRIMES)}
    places = cut(placed.withColumns(sums).select("conv_id", "turn", "m", "i", "words", *sums))
    ends = places.select("conv_id", "turn", "m", F.col("i").alias("end"), F.col("words").alias("_words"), *(F.col(s).alias(f"_{s}") for s in sums))
    runs = places.join(lengths.select("conv_id", "lines").distinct(), "conv_id").withColumn("end", F.col("i") + F.col("lines")).join(ends, ["conv_id", "turn", "m", "end"])
    between = [
        (F.pmod(F.col(f"_s{k}") - F.col(f"s{k}"), F.lit(prime)) * _power(pow(base, -1, prime), prime, F.col("words")) % F.lit(prime)).alias(f"h{k}") for k, (prime, base) in enumerate(PRIMES)
    ]
    found = runs.select("conv_id", "lines", "turn", F.struct((F.col("_words") - F.col("words")).alias("words"), *between).alias("print"))
    return found.where("print.words > 0").groupBy("conv_id", "lines", "print").agg(F.min("turn").alias("said"))


def answers(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, parent_turn): the turn that each message with a linked quotation answers."""
    quoted = cut(quotations(messages))
    quoting = quoted.select("conv_id").distinct()
    # only conversations with quotations are indexed
    asked = messages.where("conv_id is not null and turn is not null").join(quoting, "conv_id", "left_semi")
    linked = cut(quoted.join(originals(asked), ["conv_id", "hash"], "left"))
    rest = linked.where("lines > 1 and (said is null or said >= turn)").drop("said")
    found = linked.where("said < turn")
    if not rest.isEmpty():
        found = found.unionByName(rest.join(lines_in_a_row(asked, rest.select("conv_id", "lines").distinct()), ["conv_id", "lines", "print"]).where("said < turn"))
    return found.groupBy("conv_id", "turn").agg(F.max_by("said", F.struct(-F.col("level"), "said")).alias("parent_turn"))


def places(parents: DataFrame) -> DataFrame:
    """(conv_id, turn, behind): each linked message, how many of its thread stand behind it in reply order, itself included; parents: conv_id, turn, parent_turn.

    The walk enters a message, goes through its answers and leaves it; the steps of the walk are a list, whose ranks are
    found by doubling the steps. Each step is a row that knows the next one, so that no thread is held as a whole.
    """
    nodes = parents.select("conv_id", "turn", "parent_turn").unionByName(
        parents.select("conv_id", F.col("parent_turn").alias("turn")).distinct().join(parents.select("conv_id", "turn"), ["conv_id", "turn"], "left_anti").withColumn("parent_turn", F.lit(None).cast(parents.schema["turn"].dataType))
    )
    eldest = parents.groupBy("conv_id", F.col("parent_turn").alias("turn")).agg(F.min("turn").alias("child"))
    brother = F.when(F.col("parent_turn").isNotNull(), F.lead("turn").over(Window.partitionBy("conv_id", "parent_turn").orderBy("turn")))
    known = nodes.withColumn("brother", brother).join(eldest, ["conv_id", "turn"], "left")
    step = lambda turn, out, to, to_out, n: F.struct(turn.alias("turn"), F.lit(out).alias("out"), to.alias("to"), to_out.alias("to_out"), F.lit(n).cast("long").alias("n"))
    enter = step(F.col("turn"), False, F.coalesce("child", "turn"), F.col("child").isNull(), 1)
    leave = step(F.col("turn"), True, F.coalesce("brother", "parent_turn"), F.col("brother").isNull(), 0)
    walk = cut(known.select("conv_id", F.inline(F.array(enter, leave))))
    for _ in range(MOST_ROUNDS):
        if walk.where("to is not null").isEmpty():
            break
        ahead = walk.select("conv_id", F.col("turn").alias("to"), F.col("out").alias("to_out"), F.col("to").alias("_to"), F.col("to_out").alias("_to_out"), F.col("n").alias("_n"))
        met = walk.join(ahead, ["conv_id", "to", "to_out"], "left")
        walk = cut(met.select("conv_id", "turn", "out", F.col("_to").alias("to"), F.col("_to_out").alias("to_out"), (F.col("n") + F.coalesce("_n", F.lit(0))).alias("n")))
    else:
        raise RuntimeError("the walks did not end")
    return walk.where("not out").select("conv_id", "turn", F.col("n").alias("behind"))


def threads(parents: DataFrame) -> DataFrame:
    """(conv_id, turn, parent_turn, thread_turn): the message that answers lead back to, by doubling the steps back."""
    now = cut(parents.withColumn("thread_turn", F.col("parent_turn")))
    if now.isEmpty():
        return now
    for _ in range(MOST_ROUNDS):
        up = now.select("conv_id", F.col("turn").alias("thread_turn"), F.col("thread_turn").alias("further"))
        moved = now.join(up, ["conv_id", "thread_turn"], "left")
        moved = cut(moved.select("conv_id", "turn", "parent_turn", F.coalesce("further", "thread_turn").alias("thread_turn"), F.col("further").isNotNull().alias("moved")))
        now = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return now
    raise RuntimeError("the threads did not settle")


def formatted(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, text (own words), parent_turn, thread_turn, conversation, place and the message as a chat turn, a row for each row."""
    plain = messages.select("conv_id", "turn", "role", "text")
    found = threads(answers(plain))
    if found.isEmpty():  # nothing is linked: no text moves
        placed = plain.withColumns({"parent_turn": F.lit(None).cast(plain.schema["turn"].dataType), "thread_turn": F.col("turn"), "place": F.lit(0).cast("long")})
    else:
        rank = places(found)
        whole = rank.select("conv_id", F.col("turn").alias("thread_turn"), F.col("behind").alias("_whole"))
        linked = found.join(rank, ["conv_id", "turn"]).join(whole, ["conv_id", "thread_turn"])
        linked = linked.select("conv_id", "turn", "parent_turn", F.col("thread_turn").alias("_thread"), (F.col("_whole") - F.col("behind")).alias("_place"))
        placed = plain.join(linked, ["conv_id", "turn"], "left").withColumns({"thread_turn": F.coalesce("_thread", "turn"), "place": F.coalesce("_place", F.lit(0).cast("long"))})
    own = own_words(F.col("text"))
    return placed.select(
        "conv_id",
        "turn",
        "role",
        own.alias("text"),
        "parent_turn",
        "thread_turn",
        F.concat_ws(":", F.col("conv_id").cast("string"), F.col("thread_turn").cast("string")).alias("conversation"),
        "place",
        F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), own, F.lit("\n")).alias("chat"),
    )
