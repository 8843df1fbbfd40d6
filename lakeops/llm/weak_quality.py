"""Text quality by weak supervision: rules vote or abstain, expectation-maximisation weighs them, a posterior decides."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.session import written

#: Words of a window that is looked for twice in a text.
WINDOW = 8
# Fixed values of the base rules: fewest words, and the percentage of words in repeated windows that is too much.
LEAST_WORDS = 20
MOST_REPEATED = 30

_BLANKS = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
_ENDS = ".!?…。！？"

BAD, GOOD = -1, 1
#: Believed beforehand: the share of good texts, and the share of bad and of good texts on which a rule votes: one that
#: knows a fault, and one that knows a merit.
GOOD_SHARE = 0.85
FAULT_RATES = (0.3, 0.01)
MERIT_RATES = (0.3, 0.9)
#: What is believed counts like so many documents for each one there is, so that a large and a small corpus behave alike.
BELIEF_WEIGHT = 0.1
#: The rounds end when no probability moves by more, and at the latest after so many.
SETTLED, MOST_ROUNDS = 1e-4, 40
#: Texts with a smaller probability of being good go.
LEAST_QUALITY = 0.5


def _count(text: Column, characters: str) -> Column:
    """How many characters of ``text`` are among ``characters``."""
    return F.char_length(text) - F.char_length(F.translate(text, characters, ""))


def _words(text: Column) -> Column:
    plain = F.translate(text, _BLANKS, " " * len(_BLANKS))
    return F.array_remove(F.split(plain, " "), "")


def measured(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """What the rules look at, per row: ``id`` and counts of words, characters, lines and repeats over the whole text.

    Words are runs without a blank of ASCII. ``n_repeat_words`` counts the words that lie in a window of eight words
    found at least twice in the text. Windows are told apart by a 64-bit hash of their words; the hashes of a text
    are sorted with their places, so the work is n log n also where all windows are alike. Null counts as empty.
    Other columns are not read.
    """
    texts = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    cut = texts.withColumn("words", _words(F.col("text"))).withColumn(
        "lines", F.filter(F.split("text", "\n"), lambda line: F.translate(line, _BLANKS, "") != "")
    )
    n = F.size("words")
    hashed = F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda at: F.xxhash64(F.slice("words", at, WINDOW)))
    windows = cut.withColumn("windows", F.when(n >= WINDOW, hashed).otherwise(F.array().cast("array<bigint>")))
    twice = F.size(F.array_distinct("windows")) < F.size("windows")
    in_order = F.sort_array(F.transform("windows", lambda value, at: F.struct(value.alias("value"), at.alias("at"))))
    # Each list is a column of its own: inside a lambda an expression would be worked out again for every element.
    found = (
        windows.withColumn("placed", F.when(twice, in_order))
        .withColumn("places", F.when(F.col("placed").isNotNull(), F.sort_array(_repeated_places(F.col("placed")))))
        .withColumn("covered", F.coalesce(_covered(F.col("places")), F.lit(0)))
    )
    # Most characters are letters: the others, taken out once, are short to look through.
    other = found.withColumn("other", F.regexp_replace("text", r"\p{L}+", "")).withColumn(
        "capitals", F.regexp_replace("text", r"\P{Lu}+", "")
    )
    return other.select(
        F.col("id").alias(id),
        n.cast("bigint").alias("n_words"),
        (F.char_length("text") - _count(F.col("other"), _BLANKS)).cast("bigint").alias("word_chars"),
        _count(F.col("other"), _SYMBOLS).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.col("covered").cast("bigint").alias("n_repeat_words"),
        F.size("lines").alias("n_lines"),
        F.size(F.array_distinct("words")).alias("n_distinct_words"),
        (F.char_length("text") - F.char_length("other")).alias("n_letters"),
        F.char_length("capitals").alias("n_capitals"),
        _count(F.col("other"), "0123456789").alias("n_digits"),
        _count(F.col("other"), _ENDS).alias("n_ends"),
        _count(F.col("other"), "!?").alias("n_shouts"),
    )


def _repeated_places(placed: Column) -> Column:
    """Places of the windows whose hash is also that of a neighbour in the sorted list."""

    def alike(one: Column, at: Column) -> Column:
        return F.coalesce(F.get(placed, at)["value"] == one["value"], F.lit(False))

    flagged = F.transform(placed, lambda one, at: F.when(alike(one, at - 1) | alike(one, at + 1), one["at"]))
    return F.filter(flagged, lambda at: at.isNotNull())


def _covered(places: Column) -> Column:
    """How many words lie in windows that begin at the sorted ``places``."""
    return F.aggregate(
        places,
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda seen, at: F.struct((seen["n"] + F.least(F.lit(WINDOW), at - seen["last"])).alias("n"), at.alias("last")),
        lambda seen: seen["n"],
    )


def rules() -> dict[str, tuple[int, Column]]:
    """Each rule's name, its vote (BAD or GOOD) and when it votes; it abstains otherwise. They look at ``measured``.

    Most rules know one fault each. Three vote for a text that is as prose usually is in several respects at once.
    """
    n, chars, lines = F.col("n_words"), F.col("word_chars"), F.col("n_lines")
    symbols, letters, capitals = F.col("n_symbols"), F.col("n_letters"), F.col("n_capitals")
    shouts, ends, digits = F.col("n_shouts"), F.col("n_ends"), F.col("n_digits")
    variety = F.col("n_distinct_words") / F.sqrt(F.greatest(n, F.lit(1)))
    faults = {
        "symbols": symbols * 10 > n,
        "letters": letters * 100 < chars * 75,
        "capitals": capitals * 10 > letters * 4,
        "shouting": shouts * 10 > n,
        "sentences": ((ends == 0) & (n >= 50)) | (ends * 2 > n),
        "variety": variety < 2,
        "repeats": F.col("n_repeat_words") * 10 > n,
        "lines": F.col("n_dup_lines") * 10 > lines * 3,
        "word_length": (chars * 2 < n * 5) | (chars > n * 12),
        "digits": digits * 100 > chars * 15,
    }
    merits = {
        "prose": (letters * 100 >= chars * 88) & ends.between(n / 50, n / 4) & chars.between(n * 3, n * 9),
        "clean": (symbols * 100 <= n) & (shouts * 100 <= n * 3) & (capitals * 100 <= letters * 15),
        "rich": (variety >= 3) & (F.col("n_repeat_words") * 50 <= n),
    }
    return {name: (BAD, found) for name, found in faults.items()} | {name: (GOOD, found) for name, found in merits.items()}


def votes() -> Column:
    """The votes of all rules on a measured row, in their order, 0 for abstaining. Without a word all abstain."""
    cast = (F.when((F.col("n_words") > 0) & found, vote).otherwise(0).cast("tinyint") for vote, found in rules().values())
    return F.array(*cast)


@dataclass(frozen=True)
class Rates:
    """What expectation-maximisation found: the share of good texts, each rule's vote, and the share of bad and of good
    texts on which it is cast."""

    good_share: float
    votes: tuple[int, ...]
    on_bad: tuple[float, ...]
    on_good: tuple[float, ...]

    def accuracies(self) -> list[float]:
        """For every rule how often it is right where it votes."""
        found = []
        for vote, bad, good in zip(self.votes, self.on_bad, self.on_good, strict=True):
            bad, good = (1 - self.good_share) * bad, self.good_share * good
            found.append((good if vote == GOOD else bad) / (good + bad))
        return found

    def quality(self, votes: Column) -> Column:
        """The probability that a text with these votes is good, if rules err independently of each other. Abstaining
        counts as well: by how much is the sum that a text without any vote starts with."""
        odds = math.log(self.good_share / (1 - self.good_share))
        weights = []
        for bad, good in zip(self.on_bad, self.on_good, strict=True):
            silent = math.log((1 - good) / (1 - bad))
            odds += silent
            weights.append(math.log(good / bad) - silent)
        each = F.zip_with(votes, F.lit(weights), lambda vote, weight: F.abs(vote) * weight)
        return 1 / (1 + F.exp(-F.aggregate(each, F.lit(odds), lambda total, one: total + one)))


def believed() -> Rates:
    """What stands before the first document is seen."""
    cast = tuple(vote for vote, _ in rules().values())
    on_bad, on_good = zip(*(FAULT_RATES if vote == BAD else MERIT_RATES for vote in cast), strict=True)
    return Rates(GOOD_SHARE, cast, on_bad, on_good)


def estimate(cast: DataFrame) -> Rates:
    """How often the rules are right, from the column ``votes`` alone, by expectation-maximisation.

    Documents with the same votes count together: a round works on as many rows as there are different votes, whatever
    the number of documents, and returns two sums per rule. What is believed beforehand keeps good and bad from changing
    places, and stands where there is nothing to learn from.
    """
    patterns = written(cast.groupBy("votes").agg(F.count("*").alias("n")), "vote-patterns")
    known = believed()
    for _ in range(MOST_ROUNDS):
        found = _maximised(patterns, known)
        before = (known.good_share, *known.on_bad, *known.on_good)
        moved = max(abs(a - b) for a, b in zip((found.good_share, *found.on_bad, *found.on_good), before, strict=True))
        known = found
        if moved < SETTLED:
            break
    return known


def _maximised(patterns: DataFrame, known: Rates) -> Rates:
    """The rates that fit best if the probabilities by ``known`` hold."""
    weighed = patterns.withColumn("good", F.col("n") * known.quality(F.col("votes")))
    sums = (
        weighed.select("n", "good", F.posexplode("votes").alias("rule", "vote"))
        .groupBy("rule")
        .agg(
            F.sum("n").alias("n"),
            F.sum("good").alias("good"),
            F.sum(F.when(F.col("vote") != 0, F.col("n")).otherwise(0)).alias("cast"),
            F.sum(F.when(F.col("vote") != 0, F.col("good")).otherwise(0.0)).alias("cast_good"),
        )
        .collect()
    )
    # Every document is in the sums of every rule.
    total, good = (sums[0]["n"], sums[0]["good"]) if sums else (0, 0.0)
    seen = {row["rule"]: (row["cast"] - row["cast_good"], row["cast_good"]) for row in sums}
    start, belief = believed(), BELIEF_WEIGHT * (total or 1)
    on_bad, on_good = [], []
    for rule in range(len(known.votes)):
        cast_bad, cast_good = seen.get(rule, (0.0, 0.0))
        on_bad.append((cast_bad + belief * start.on_bad[rule]) / (total - good + belief))
        on_good.append((cast_good + belief * start.on_good[rule]) / (good + belief))
    return Rates((good + belief * GOOD_SHARE) / (total + belief), known.votes, tuple(on_bad), tuple(on_good))


def judged(docs: DataFrame, id: str = "doc_id", text: str = "text", known: Rates | None = None) -> DataFrame:
    """``id``, all measures, ``votes``, ``quality`` (the probability of being good), ``base_failed`` and ``kept``.

    Too few words or too many in repeated windows fail a text whatever the rules say; of the others those stay whose
    quality is LEAST_QUALITY or more. Null, empty and blank texts fail. Repeated rows are judged alike and count as often
    as they are there, a null id is an id, an empty table gives an empty result, other columns are not read. Without
    ``known`` the rules' accuracies are estimated from all rows of ``docs``.
    """
    cast = written(measured(docs, id, text).withColumn("votes", votes()), "measured")
    known = known or estimate(cast)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return (
        cast.withColumn("quality", known.quality(F.col("votes")))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= LEAST_QUALITY))
    )


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is kept, with all their columns."""
    whole = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    return judged(whole, "row", "text").filter("kept").select("row.*")
