"""Language identification, decontamination, surrogates and quotations."""

from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.llm import decontamination as dc
from lakeops.llm import language, quotations, surrogates

from .conftest import WORDS, prose

# --- language


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(k, prose(k, 60, lang), lang) for k, lang in enumerate(list(WORDS) * 80)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_accuracy(spark, labelled):
    noisy = labelled.filter("doc_id % 4 <> 2").withColumn("lang", F.expr("CASE WHEN doc_id % 29 = 0 THEN 'en' ELSE lang END"))
    model = language.learn(noisy)
    got = language.predict(labelled, model).join(labelled, "doc_id").filter("doc_id % 4 = 2")
    assert got.filter("lang_pred = lang").count() >= 0.98 * got.count()
    short = spark.createDataFrame([(k, prose(900 + k, 6, lang), lang) for k, lang in enumerate(list(WORDS) * 30)], labelled.schema)
    got = language.predict(short, model).join(short, "doc_id")
    assert got.filter("lang_pred = lang").count() >= 0.9 * got.count()
    assert got.filter("score < 0 OR score > 1").isEmpty()


def test_filter_holds_all_that_was_put_in_and_few_others():
    draw = np.random.default_rng(1)
    gram = draw.choice(1 << 31, 30_000, replace=False).astype(np.int64) + 1
    lang = draw.integers(0, 5, 30_000)
    model = language.build(list("abcde"), lang, gram)
    masks = model.masks(gram)
    assert ((masks >> lang.astype(np.uint64)) & np.uint64(1)).all()
    other = model.masks(draw.integers(1 << 32, 1 << 33, 50_000))
    for bit in range(5):
        rate = np.mean((other >> np.uint64(bit)) & np.uint64(1))
        assert abs(rate - model.false_rate[bit]) < 0.005


def test_grams_are_all_windows_of_each_text():
    value, starts = language.grams(["Ab", None, "é1 c"])
    texts = [b"  ab  ", b"    ", "  é  c  ".encode()]
    for k, text in enumerate(texts):
        wanted = [int.from_bytes(text[i : i + 4], "big") for i in range(len(text) - 3) if text[i : i + 4].strip()]
        assert [int(v) for v in value[starts[k] : starts[k + 1]] if v] == wanted


def test_language_of_odd_rows_and_without_labels(spark, labelled, odd_docs, no_docs):
    model = language.learn(labelled)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(odd_docs, model).collect()}
    assert all(got[i] == ("und", 0.0) for i in (9001, 9002, 9003, 9004))
    assert got[9006][0] in WORDS and got[9008][0] in WORDS and None in got
    assert language.predict(no_docs, model).count() == 0
    untaught = language.learn(labelled.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in language.predict(odd_docs, untaught).collect()} == {"und"}
    kept = language.keep_known(odd_docs.union(odd_docs.limit(0)), model, 0.2)
    assert kept.columns == odd_docs.columns and not {9001, 9002, 9003, 9004} & {r["doc_id"] for r in kept.collect()}


def test_more_languages_than_a_mask_has_bits(spark):
    """150 languages of invented words; every one is told from the others, in each of three masks."""
    draw = random.Random(8)
    vocabularies = [["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=5)) for _ in range(12)] for _ in range(150)]
    rows = [(k, " ".join(draw.choices(words, k=40)), f"l{k % 150:03d}") for k, words in enumerate(vocabularies * 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.learn(frame.filter("doc_id < 300"))
    assert len(model.languages) == 150 and model.slots.shape[0] == 3
    got = {r["doc_id"]: r["lang_pred"] for r in language.predict(frame.filter("doc_id >= 300"), model).collect()}
    assert got == {k: lang for k, _, lang in rows if k >= 300}
    assert language.keep_known(frame, model, 0.2).count() == len(rows)


# --- decontamination


def items(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def changed(words: list[str], places) -> list[str]:
    return ["changed" if k in places else w for k, w in enumerate(words)]


def test_overlaps_are_found_with_substitutions_and_in_part_and_clean_texts_are_not(spark):
    passages = [prose(500 + k, 40) for k in range(6)] + [prose(600, 8)]
    before, after = prose(1, 70), prose(2, 70)
    bench = passages[0].split(" ")
    docs = {
        1: f"{before} {passages[0].upper()} {after}",
        2: f"{before} {' '.join(changed(bench, {3, 12, 21, 33}))} {after}",
        3: f"{before} {' '.join(bench[10:30])} {after}",
        4: f"{before} {passages[6]} {after} {passages[1]}",
        5: f"{before} {after}",
        6: f"{' '.join(bench[:7])} {before} {' '.join(bench[20:26])}",
        7: f"{before} {' '.join(changed(bench, set(range(0, 40, 2))))}",
        8: passages[2].replace(" ", " , "),
    }
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    got = {(r["doc_id"], r["item_id"]): r for r in dc.overlaps(frame, items(spark, passages)).collect()}
    assert set(got) == {(1, 0), (2, 0), (3, 0), (4, 6), (4, 1), (8, 2)}
    assert (got[1, 0]["n_equal"], got[1, 0]["doc_start"], got[1, 0]["item_start"]) == (40, 70, 0)
    assert (got[2, 0]["n_equal"], got[2, 0]["n_words"]) == (36, 40)
    assert (got[3, 0]["n_equal"], got[3, 0]["item_start"]) == (20, 10)
    left = {r["doc_id"] for r in dc.decontaminate(frame, items(spark, passages)).collect()}
    assert left == {5, 6, 7}


def test_any_two_changes_in_a_long_passage_are_forgiven(spark):
    bench = prose(700, 24).split(" ")
    draw = random.Random(1)
    docs = [(k, " ".join(changed(bench, set(draw.sample(range(24), 2))))) for k in range(60)]
    got = dc.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), items(spark, [" ".join(bench)]))
    assert got.count() == 60


def test_overlap_has_the_most_equal_words_of_all_stretches_with_the_share():
    draw = np.random.default_rng(1)
    for _ in range(300):
        equal = draw.random(draw.integers(0, 40)) < draw.choice([0.5, 0.7, 0.8])
        start, stop, count = dc.overlap(equal)
        spans = [(a, b) for a in range(len(equal)) for b in range(a + 1, len(equal) + 1) if 5 * equal[a:b].sum() >= 4 * (b - a)]
        assert count == max((equal[a:b].sum() for a, b in spans), default=0) == equal[start:stop].sum()
        assert stop - start == min((b - a for a, b in spans if equal[a:b].sum() == count), default=0) or not count


def test_a_longer_stretch_below_the_share_does_not_hide_a_verbatim_run(spark):
    bench = prose(710, 49).split(" ")
    text = " ".join(changed(bench, {*range(12, 17), *range(29, 35)}))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (row,) = dc.overlaps(docs, items(spark, [" ".join(bench)])).collect()
    assert row["n_equal"] >= 14 and row["n_equal"] >= 0.8 * row["n_words"]


def test_masks_hit_every_pattern_that_the_rule_accepts():
    for words in range(dc.LEAST_WORDS, dc.LONG + 1):
        masks = [(int(mask, 2), len(mask)) for _, mask in dc.masks_for(words)]
        for n in range(2, 24 if words == dc.LONG else words + 1):
            for others in range(n // 5 + 1):
                if not dc.accepted(0, n, n - others, words):
                    continue
                for places in itertools.combinations(range(1, n - 1), others):
                    pattern = (1 << n) - 1 - sum(1 << k for k in places)
                    hit = any((pattern >> at) & mask == mask for mask, span in masks for at in range(n - span + 1))
                    assert hit, (words, n, places)


def test_short_overlaps_and_changed_short_items_are_found(spark):
    bench, draw = [prose(720 + k, n) for k, n in enumerate((40, 5, 7, 9, 11))], random.Random(4)
    long = bench[0].split(" ")
    docs = {1: long[5:15], 2: long[20:31], 3: changed(long[:15], {3, 7, 11})}
    docs |= {10 * k + place: changed(bench[k].split(" "), {place}) for k in (1, 2, 3, 4) for place in range(len(bench[k].split(" ")))}
    rows = [(i, f"{prose(800 + i, 30)} {' '.join(part)} {prose(900 + i, 30)}") for i, part in docs.items()]
    draw.shuffle(rows)
    found = dc.overlaps(spark.createDataFrame(rows, "doc_id long, text string"), items(spark, bench)).collect()
    assert {(i, i // 10) for i in docs if i < 45} <= {(r["doc_id"], r["item_id"]) for r in found}


def test_decontamination_goes_by_texts_and_not_by_ids(spark):
    """Items that share an id, documents without one, and rows that share one and not the text."""
    one, two, clean = prose(910, 30), prose(911, 30), prose(912, 60)
    bench = spark.createDataFrame([(1, one), (1, two), (None, prose(913, 30))], "item_id long, text string")
    rows = [(1, f"{clean} {one}"), (2, two), (None, one), (None, clean), (3, clean), (3, two), (4, prose(913, 30)), (5, None), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("doc", F.lit(1)).withColumn("row", F.lit(2))
    kept = dc.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect()) == sorted([(0, clean), (3, clean), (5, ""), (6, "")])
    found = {(r["doc_id"], r["item_id"]) for r in dc.overlaps(docs.drop("doc", "row"), bench).collect()}
    assert found == {(1, 1), (2, 1), (3, 1)}


def test_short_items_match_equal_texts_and_unspaced_ones_their_characters(spark):
    chinese = "这是一个用来检查去污染方法的句子它没有空格"
    bench = items(spark, ["Paris", "forty two", "the red fox ran", chinese])
    rows = [
        (1, "paris!"), (2, "Paris is large"), (3, "Forty  two."), (4, "forty two and more"), (5, "The red fox ran"),
        (6, "the red fox sat"), (7, "前面的话" + chinese + "后面的话"), (8, "完全不同的另外一句中文没有任何关系"), (9, "two forty"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"] for r in dc.overlaps(docs, bench).collect()} == {1, 3, 5, 7}
    assert {r["doc_id"] for r in dc.decontaminate(docs, bench).collect()} == {2, 4, 6, 8, 9}


def test_decontamination_of_odd_rows(spark, odd_docs, no_docs):
    bench = items(spark, [None, "", "tie tie tie tie tie tie tie", "a b", prose(3, 30), "日本語のテキスト"])
    found = {(r["doc_id"], r["item_id"]) for r in dc.overlaps(odd_docs, bench.union(bench)).collect()}
    # Each character of the Japanese item is a word, so the text that begins with it is found.
    assert found == {(9006, 5), (9009, 2), (9010, 2)}
    kept = dc.decontaminate(odd_docs, bench)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 3
    assert dc.overlaps(no_docs, bench).count() == 0 and dc.overlaps(odd_docs, bench.limit(0)).count() == 0


# --- surrogates

PII = [
    (1, "Mail ANNA.B@mail7.Example.com or anna.b@mail7.example.com, +1 (017) 555-7713 / 017-555-7713."),
    (2, "Card 4111 1111 1111 1111 and 4263429643439180, 97.51.17.173 and 192.168.1.9, ssn 123-45-6789."),
    (3, "Frau Schmidt met Anna Schmidt, Peter SCHMIDT and Елена Иванова, Пётр Иванов."),
    (4, 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" v1.2.3.4.5 1999-2024 x12345678901234 and Anna alone.'),
    (5, "again anna.b@mail7.example.com and 97.51.17.173 and Mrs Schmidt"),
]


def mentioned(docs):
    return docs.select(F.explode(surrogates.find_entities(F.col("text"))).alias("entity"))


def luhn(number: str) -> int:
    digits = [int(c) for c in reversed(number)]
    return sum(digits[::2]) + sum(d * 2 - 9 * (d > 4) for d in digits[1::2])


def test_surrogates_keep_type_format_gender_script_and_identity(spark):
    docs = spark.createDataFrame(PII, "doc_id long, text string")
    table = {r["entity"]: (r["kind"], r["replacement"]) for r in surrogates.surrogate_table(mentioned(docs), "k").collect()}
    text = {r["doc_id"]: r["text"] for r in surrogates.replace_entities(docs, "k").collect()}
    assert text[4] == PII[3][1]
    mails = re.findall(r"\S+@\w+\.example\b", text[1])
    assert len(mails) == 2 and len(set(mails)) == 1 and mails[0] in text[5]
    assert re.fullmatch(r"[a-z]{4}\.[a-z]@[a-z]{8}\.example", mails[0])
    phones = re.findall(r"\+1 \(\d{3}\) \d{3}-\d{4}|\d{3}-\d{3}-\d{4}", text[1])
    assert re.sub(r"\D", "", phones[0]) == "1" + re.sub(r"\D", "", phones[1])
    cards = re.findall(r"(?<!\d)\d{4}(?: ?\d{4}){3}", text[2])
    assert [luhn(c.replace(" ", "")) % 10 == 0 for c in cards] == [True, luhn("4263429643439180") % 10 == 0]
    assert cards[0].count(" ") == 3 and " " not in cards[1] and all(c[0] == "4" for c in cards)
    assert re.search(r"and 192\.168\.\d+\.\d+,", text[2]) and re.search(r"ssn 9\d\d-\d\d-\d{4}", text[2])
    names = re.fullmatch(r"Frau (\w+) met (\w+) (\w+), (\w+) (\w+) and (\w+) (\w+), (\w+) (\w+)\.", text[3]).groups()
    assert names[0] == names[2] and names[4] == names[0].upper() and f"Mrs {names[0]}" in text[5]
    assert names[1] in surrogates.GIVEN["latin", "f"] and names[3] in surrogates.GIVEN["latin", "m"]
    assert names[5] in surrogates.GIVEN["cyrillic", "f"] and names[7] in surrogates.GIVEN["cyrillic", "m"]
    assert names[6] == names[8] + "а"
    assert all(entity not in replacement for entity, (_, replacement) in table.items())


def test_other_keys_give_other_surrogates_and_one_key_the_same(spark):
    docs = spark.createDataFrame(PII, "doc_id long, text string")
    first, again, other = ([r["text"] for r in surrogates.replace_entities(docs, k).orderBy("doc_id").collect()] for k in ("k", "k", "j"))
    assert first == again and first[0] != other[0]


def test_distinct_things_stay_distinct_also_where_surrogates_are_few(spark):
    """All addresses of one private network: 64,516 possible surrogates for 3,000 entities, so some clash."""
    rows = [(k, f"host 192.168.{k // 250 + 1}.{k % 250 + 1} up") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = surrogates.surrogate_table(mentioned(docs), "k").collect()
    assert len(table) == len({r["replacement"] for r in table}) == 3000
    assert not {r["entity"] for r in table} & {r["replacement"] for r in table}


def entity_table(spark, entities):
    frame = spark.createDataFrame([(e,) for e in entities], "entity string")
    return {r["entity"]: (r["kind"], r["replacement"]) for r in surrogates.surrogate_table(frame, "k").collect()}


def test_full_spaces_end_and_stay_distinct(spark):
    """Every one-letter mailbox of a host, every short number, and each address of a whole network."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    boxes = [f"{a}@site.com" for a in letters] + [f"{a}{b}@site.com" for a in letters for b in letters]
    # All of the numbers a format has: all its surrogates are found in the corpus.
    phones = [f"+1 {a:02d} {b:02d}" for a in range(100) for b in range(100)]
    addresses = [f"192.168.{a}.{b}" for a in range(256) for b in range(256)]
    table = entity_table(spark, [*boxes, *phones, *addresses])
    assert len(table) == len(boxes) + len(phones) + len(addresses)
    for kind, entities in (("email", boxes), ("phone", phones), ("ip", addresses)):
        assert {table[e][0] for e in entities} == {kind}
        made = [table[e][1] for e in entities]
        assert len(set(made)) == len(made)
        assert not set(made) & set(entities)


def test_more_surnames_than_three_syllables_have(spark):
    table = entity_table(spark, [f"Mr Q{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676 % 26)}{chr(97 + k // 17576)}" for k in range(60_000)])
    made = [replacement for _, replacement in table.values()]
    assert len(made) == 60_000 == len(set(made)) and all(name.startswith("Mr ") for name in made)


def test_a_longer_surrogate_still_agrees_in_every_format(spark):
    few = [f"+1 {a:02d} {b:02d}" for a in range(100) for b in range(100)]
    table = entity_table(spark, [*few, *[e.replace(" ", "-") for e in few], *[e.replace(" ", ".") for e in few]])
    plain = {e: table[e][1] for e in few}
    assert len(set(plain.values())) == len(few)
    for e, made in plain.items():
        assert table[e.replace(" ", "-")][1] == made.replace(" ", "-")
        assert table[e.replace(" ", ".")][1] == made.replace(" ", ".")


def test_surrogates_of_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs.union(spark.createDataFrame([(None, "to a.b@c.org", None, None, 1, "x")] * 2, odd_docs.schema))
    got = surrogates.replace_entities(docs, "k")
    assert got.columns == docs.columns and got.count() == docs.count()
    assert got.filter("text RLIKE 'a.b@c.org'").isEmpty() and got.filter("text RLIKE '^to [a-z][.][a-z]@[a-z]{8}[.]example$'").count() == 2
    assert got.select("text").exceptAll(docs.select("text")).count() == 2
    assert surrogates.replace_entities(no_docs, "k").count() == 0
    assert surrogates.replacement_report(odd_docs, "k").filter("n_email + n_phone + n_ip + n_card + n_ssn + n_name > 0").isEmpty()


# --- quotations


def test_passages_are_runs_of_one_level(spark):
    body = "hello\n> > old\n>> older\n> reply\n\nOn Monday A wrote:\n> x > y\nend"
    row = spark.createDataFrame([(body,)], "b string").select(quotations.passages(F.col("b")).alias("p")).first()["p"]
    assert [p["raw"] for p in row] == ["hello", ">> old\n>> older", "> reply", "\nOn Monday A wrote:", "> x > y", "end"]
    assert [(p["level"], p["text"]) for p in row] == [
        (0, "hello"), (2, "old\nolder"), (1, "reply"), (0, "\nOn Monday A wrote:"), (1, "x > y"), (0, "end"),
    ]
    own = spark.createDataFrame([(body,)], "b string").select(quotations.own_text(quotations.passages(F.col("b"))).alias("o"))
    assert own.first()["o"] == "hello\n\nend"


def threaded(spark, rows):
    frame = spark.createDataFrame(rows, "msg_id string, thread long, sent long, body string").repartition(3)
    return {r["msg_id"]: r for r in quotations.reply_ordered(frame).collect()}


def test_links_go_to_the_latest_earlier_message_that_says_the_same(spark):
    got = threaded(
        spark,
        [
            ("a", 1, 1, "First thing said here."),
            ("b", 1, 2, "> first   thing SAID here.\nAn answer to the first."),
            ("c", 1, 3, "First thing said here."),
            ("d", 1, 4, "> First thing said here.\nTo the second of them."),
            ("e", 1, 5, "> > First thing said here.\n> An answer to the first.\nDeeper now."),
            ("f", 2, 6, "> An answer to the first.\nOf another thread."),
            ("g", 1, 7, "> a line nobody wrote at all\nLost."),
            ("h", 1, 8, "Top.\nA longer line that can be quoted alone.\nBottom."),
            ("i", 1, 9, "> A longer line that can be quoted alone.\nPart of it."),
            ("j", 1, 10, "I say this.\n> I say this.\n"),
        ],
    )
    assert {m: r["reply_to"] for m, r in got.items()} == {
        "a": None, "b": "a", "c": None, "d": "c", "e": "b", "f": None, "g": None, "h": None, "i": "h", "j": None,
    }
    assert [got[m]["root"] for m in "abcde"] == ["a", "a", "c", "c", "a"]
    assert [(got[m]["depth"], got[m]["position"]) for m in "abe"] == [(0, 1), (1, 2), (2, 3)]
    assert got["e"]["own"] == "Deeper now." and got["e"]["n_linked"] == 2 and got["i"]["own"] == "Part of it."


def test_a_long_chain_and_a_text_that_all_messages_share(spark):
    chain = [(f"m{k:03d}", 1, k, (f"> message number {k - 1} is this\n" if k else "") + f"message number {k} is this") for k in range(70)]
    same = [(f"s{k:03d}", 2, k, "> we all say the same\nwe all say the same") for k in range(150)]
    got = threaded(spark, chain + same)
    assert all(got[f"m{k:03d}"]["root"] == "m000" and got[f"m{k:03d}"]["depth"] == k == got[f"m{k:03d}"]["position"] - 1 for k in range(70))
    assert all(got[f"s{k:03d}"]["reply_to"] == (f"s{k - 1:03d}" if k else None) for k in range(150))


def test_only_what_is_linked_goes(spark):
    long = "On Monday, " + "very " * 90 + "late, the teacher wrote:"
    got = threaded(
        spark,
        [
            ("a", 1, 1, "On Monday the teacher wrote:"),
            ("b", 1, 2, "The sun was out all day long.\nAnd nobody stayed at home."),
            ("c", 1, 3, "I agree.\nOn Monday B wrote:\n> The sun was out all day long.\n> And nobody stayed at home.\nSo do I."),
            ("d", 1, 4, "As someone said:\nOn Friday X wrote:\n> words from a message we never saw\nIndeed."),
            ("e", 1, 5, f"{long}\n> The sun was out all day long.\n> But I stayed in, quite alone.\nLonely."),
            ("f", 1, 6, "> On Tuesday B wrote:\n> > The sun was out all day long.\n> > And nobody stayed at home.\nDeep."),
        ],
    )
    assert {m: r["own"] for m, r in got.items()} == {
        "a": "On Monday the teacher wrote:",
        "b": "The sun was out all day long.\nAnd nobody stayed at home.",
        "c": "I agree.\nSo do I.",
        "d": "As someone said:\nOn Friday X wrote:\n> words from a message we never saw\nIndeed.",
        "e": "> But I stayed in, quite alone.\nLonely.",
        "f": "Deep.",
    }
    assert {m: r["reply_to"] for m, r in got.items()} == {"a": None, "b": None, "c": "b", "d": None, "e": "b", "f": "b"}


def test_turns_come_back_in_order_and_without_quotes(spark):
    turns = [(c, t, "user", f"turn {t} of {c}\nsecond line {t * c}") for c in range(5) for t in range(6) if (c, t) != (2, 3)]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    frame = frame.withColumn("body", F.lit("clash")).union(frame.withColumn("body", F.lit("clash")).limit(3))
    got = quotations.reply_ordered(quotations.quoting_messages(frame)).collect()
    assert sorted((r["thread"], r["sent"], r["own"]) for r in got) == sorted((c, t, x) for c, t, _, x in turns)
    assert {(r["sent"], r["root"]) for r in got if r["thread"] == 2 and r["sent"] > 3} == {(4, "2:4"), (5, "2:4")}


def test_quotations_of_odd_rows(spark):
    rows = [(None, 1, 1, "x"), ("n", None, None, None), ("e", 1, None, ""), ("q", 1, 2, ">>>\n> \n"), ("q", 1, 2, ">>>\n> \n"), ("l", None, 3, "> a\n" * 3000)]
    got = threaded(spark, rows)
    assert set(got) == {"n", "e", "q", "l"} and all(r["reply_to"] is None for r in got.values())
    # What is quoted from nowhere stays; marks without words go.
    assert {m: r["own"] for m, r in got.items()} == {"n": "", "e": "", "q": "", "l": "\n".join(["> a"] * 3000)}
    frame = spark.createDataFrame([], "msg_id string, thread long, sent long, body string")
    assert quotations.reply_ordered(frame).count() == 0
