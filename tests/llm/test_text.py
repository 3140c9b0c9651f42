"""Text operators against brute force and hand-made cases."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidewell.llm import leakage, mixing, stuffing
from tidewell.llm.words import words

SMALL = "/root/testdata/sf0.01"
NAMES = [a + b for a in ("Os", "Hal", "Zel", "Per", "Rud", "Gor", "Tar") for b in ("vale", "dorf", "ura", "ano", "den")]


def sentence(rnd, names=NAMES):
    a = rnd.choice(["the water agency", "the audit court", "this amendment", "the school board", "our group", "the minister"])
    v = rnd.choice(["rejects", "supports", "has examined", "must publish", "would extend", "overlooks"])
    o = rnd.choice(["the levy on school meals", "the licence for wind parks", "the tariff on ferry tickets", "the subsidy for flood walls"])
    return f"In {rnd.choice(names)}, {a} of {rnd.choice(names)} {v} {o}, although {rnd.randrange(9999)} households are affected."


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(4)
    items = [(i, " ".join(sentence(rnd) for _ in range(4))) for i in range(12)]
    filler = lambda n: " ".join(sentence(rnd, ["Arden", "Belmont", "Corwen"]) for _ in range(n))
    docs = []
    for i, p in items:
        ws = p.split()
        slip = ws[5:45]
        slip[20] = "qqq"
        docs += [
            (i * 10, filler(2) + " " + p + " " + filler(2), i),
            (i * 10 + 1, filler(3) + " " + " ".join(ws[3:33]).upper().replace("OSVALE", "Ósvale") + "\n" + filler(1), i),
            (i * 10 + 2, filler(1) + " " + " ".join(slip[:15]) + " (Applause) " + "\n".join(slip[15:]) + " " + filler(2), i),
            (i * 10 + 3, filler(2) + " " + " ".join(ws[4:20]) + ". " + filler(2), None),
        ]
    docs += [(1000 + i, filler(8), None) for i in range(30)]
    return items, docs


def test_leaks_are_found_and_short_quotations_are_not(spark, corpus):
    items, docs = corpus
    d = spark.createDataFrame([(*x[:2], "x") for x in docs] + [(5000, None, "x"), (5001, "", "x"), (0, docs[0][1], "x")], "doc_id bigint, text string, item_id string")
    i = spark.createDataFrame([*items, (99, None), (None, "x"), items[0]], "item_id bigint, passage string")
    assert {tuple(r) for r in leakage.find_leaks(d, i).filter("kind = 'verbatim'").select("item_id", "doc_id").collect()} == {(item, doc) for doc, _, item in docs if item is not None}
    assert leakage.find_leaks(d, i.limit(0)).count() == 0
    assert leakage.find_leaks(d.limit(0), i).count() == 0


def test_reparameterised_copy_has_its_own_kind():
    p = "In Osvale, the water agency of Haldorf rejects the levy on school meals, although 84 households are affected. In Perano, the audit court of Rudden supports the licence for wind parks, although 17 households are affected."
    other = p.replace("Osvale", "Zelura").replace("Haldorf", "Gorby").replace("84", "12").replace("Perano", "Osvale").replace("Rudden", "Haldorf").replace("17", "99")
    unknown = p.replace("Osvale", "Quux").replace("Haldorf", "Frobia").replace("84", "3").replace("Perano", "Nowhere").replace("Rudden", "Elsewhere").replace("17", "1234")
    its = leakage.Items([(1, p), (2, "Zelura and Gorby and Osvale.")])
    assert leakage.leaks_in([words(other), words(unknown)], its) == {(0, 0): leakage.CHANGED, (1, 0): leakage.CHANGED}
    assert leakage.leaks_in([words(p)], its) == {(0, 0): leakage.VERBATIM}


def test_a_clean_stretch_is_a_quotation_whatever_follows():
    p = "In Osvale, the water agency of Haldorf rejects the levy on school meals, although 84 households are affected and the board was told so twice last year. In Perano, Rudden, Tarden and Gorano, the court of Zelura has 17 cases of 19, 23 and 29."
    q = p.replace("Perano", "Ab").replace("Rudden", "Cd").replace("Tarden", "Ef").replace("Gorano", "Gh").replace("Zelura", "Ij").replace("17", "4").replace("19", "5").replace("23", "6").replace("29", "7")
    assert leakage.leaks_in([words(q)], leakage.Items([(1, p)])) == {(0, 0): leakage.VERBATIM}


def test_blocks_of_items_give_the_same(spark, corpus, monkeypatch):
    items, docs = corpus
    # A lower-case "osvale" anywhere in the query set makes it no name everywhere.
    items = [*items, (500, "they call it osvale and zelura and so on")]
    d = spark.createDataFrame([x[:2] for x in docs], "doc_id bigint, text string")
    i = spark.createDataFrame(items, "item_id bigint, passage string")
    whole = {tuple(r) for r in leakage.find_leaks(d, i).collect()}
    monkeypatch.setattr(leakage, "BLOCK_ITEMS", 1)
    monkeypatch.setattr(leakage, "PASS_BLOCKS", 3)
    assert {tuple(r) for r in leakage.find_leaks(d, i.repartition(3)).collect()} == whole


@pytest.mark.parametrize("remark", ["x " * 145, "x " * 160, "Applause (loud) from [the] left", "y " * 900])
def test_remarks_of_any_length_and_nesting(remark):
    assert words(f"one two ({remark}) three") == ["one", "two", "three"]
    assert words("a) one b) two (three") == ["a", "one", "b", "two", "three"]


def test_a_passage_inside_brackets_is_found(spark, corpus):
    (item, p), _ = corpus[0][0], None
    d = spark.createDataFrame([(1, f"As was said ({p}), so be it.")], "doc_id bigint, text string")
    i = spark.createDataFrame([(item, p)], "item_id bigint, passage string")
    assert [tuple(r) for r in leakage.find_leaks(d, i).collect()] == [(item, 1, leakage.VERBATIM)]


def test_planted_quotations_with_frequent_slips_are_found():
    """Recall on planted quotations of 25 to 60 words with a spelling slip every 8
    to 12 words; prints what is lost."""
    rnd = random.Random(11)
    items = [(i, " ".join(sentence(rnd) for _ in range(5))) for i in range(60)]
    index = leakage.Items(items)
    texts, want = [], set()
    for n in range(300):
        i = rnd.randrange(60)
        ws = items[i][1].split()
        k = rnd.randrange(len(ws) - 25)
        quote = ws[k : k + rnd.randrange(25, 61)]
        at = rnd.randrange(4, 9)
        while at < len(quote) - 3:
            quote[at] = quote[at][:1] + quote[at][2:] + "q"
            at += rnd.randrange(8, 13)
        if len(words(" ".join(quote))) >= 25:
            want.add((n, i))
        texts.append(words(sentence(rnd, ["Arden"]) + " " + " ".join(quote) + ". " + sentence(rnd, ["Belmont"])))
    found = {k for k, kind in leakage.leaks_in(texts, index).items() if kind == leakage.VERBATIM}
    lost = want - found
    print("lost", [(n, i, " ".join(texts[n])) for n, i in sorted(lost)])
    assert len(lost) <= 0.01 * len(want)


def test_suffix_automaton_weighs_like_brute_force():
    rnd = random.Random(7)
    for _ in range(60):
        seq = [rnd.choice("abc") for _ in range(rnd.randrange(1, 40))] * rnd.randrange(1, 3)
        n = len(seq)
        want = [0.0] * n
        for length in range(1, n + 1):
            grams = [tuple(seq[i : i + length]) for i in range(n - length + 1)]
            for i, g in enumerate(grams):
                c = sum(h == g for h in grams)
                if c > 1:
                    for k in range(i, i + length):
                        want[k] = max(want[k], 1 - float(c) ** -length if length < stuffing.LONG else 1.0)
        assert stuffing.SuffixAutomaton(seq).weights() == pytest.approx(want)


SPAM = [
    "cheap flights dog beds " * 30,
    " | ".join(["Home", "Login", "Contact", "Dog Beds", "Sitemap", "Help"] * 15),
    " ".join(f"#tag{'abc'[i % 3]}" for i in range(90)).replace("#taga", "#dogbeds").replace("#tagb", "#loans").replace("#tagc", "#shoes"),
    "\n".join(f'<a href="https://shop{i}.example/p{i}">running shoes</a>' for i in range(30)),
    "\n".join(f"SKU-{i} | garden sheds Maple | {i}.50 | SALE" for i in range(25)),
    "today solar lamps for you solar lamps solar lamps online. now solar lamps near garden sheds solar lamps buy. " * 9,
]
PLAIN = [
    "\n".join(f"Water supply act, § {i}. Is there any objection? There is none, and it is so decided." for i in range(15)),
    "The sitting is open. Ayes (40): " + ", ".join(f"Name{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(40)) + ".",
    " ".join(sentence(random.Random(i)) for i in range(12)),
    None,
    "",
    "12 34 56",
]


ENGLISH = frozenset("the a an of and or to in on at for is are was were be it its with by from as that this there any none so has have not although".split())
POLISH = (
    "Szanowni państwo, proszę o spokój na sali. Komisja budżetowa przyjęła wniosek w sprawie szkół. Wniosek ten został poparty przez większość członków komisji. "
    "Rząd nie zgodził się na zmianę ustawy w tym zakresie. Posłowie opozycji zgłosili sprzeciw i poprosili o przerwę. Po przerwie komisja wróciła do głosowania nad wnioskiem."
)


def test_list_pages_are_told_from_formulas_and_roll_calls(spark):
    assert [stuffing.is_stuffed(t, ENGLISH) for t in SPAM] == [True] * len(SPAM)
    assert [stuffing.is_stuffed(t, ENGLISH) for t in PLAIN] == [False] * len(PLAIN)
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(SPAM + PLAIN)] * 2, "doc_id bigint, text string, listed int")
    assert sorted(r.doc_id for r in stuffing.find_stuffed(df, ENGLISH).collect()) == list(range(len(SPAM)))
    assert stuffing.is_stuffed(SPAM[0] * 200, ENGLISH)
    assert stuffing.find_stuffed(df.limit(0)).count() == 0


def test_a_language_without_common_words_is_no_spam():
    assert not stuffing.is_stuffed(POLISH) and not stuffing.is_stuffed(POLISH, ENGLISH)


def test_no_step_in_the_length_of_a_text():
    """Keywords that are there twice each, at every length around the old bound."""
    assert all(stuffing.is_stuffed(" ".join(f"keyword{i} keyword{i}" for i in range(n))) for n in range(10, 90, 4))


def test_common_words_are_those_of_the_corpus(spark):
    rnd = random.Random(5)
    rows = [(" ".join(sentence(rnd) for _ in range(3)), "en" if i % 2 else " EN ") for i in range(60)] + [(POLISH, "pl"), (None, None), ("", "en"), ("pool pool", None)]
    df = spark.createDataFrame(rows, "text string, lang string")
    common = stuffing.common_words(df)
    assert {"the", "of", "in", "although"} <= common and not {"komisja", "pool", "osvale"} & common
    assert stuffing.common_words(df.repartition(7)) == common


def test_bounds_before_the_automaton_lose_nothing(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = [r.text for r in docs.select("text").collect()]
    common = stuffing.common_words(docs)
    fast = [stuffing.is_stuffed(t, common) for t in texts]
    least, most = stuffing.LEAST_SHARE, stuffing.CLAUSE_SHARE
    monkeypatch.setattr(stuffing, "LEAST_SHARE", 0.0)
    monkeypatch.setattr(stuffing, "CLAUSE_SHARE", 2.0)
    full = [stuffing.shares(t, common) for t in texts]
    assert fast == [a > least and c < min(most, a) for a, c in full]


def test_token_counts_equal_the_tokenizer(spark):
    df = spark.read.parquet(f"{SMALL}/documents.parquet").limit(50)
    enc = mixing._encoder(mixing.VOCABULARY)
    got = {r.doc_id: r.n_tokens for r in mixing.token_counts(df).collect()}
    assert got == {r.doc_id: len(enc.encode_ordinary(r.text or "")) for r in df.collect()}


def test_mix_reaches_shares_within_caps(spark):
    docs = spark.createDataFrame(
        [(i, "big" if i % 10 else "small", "word " * (20 + i % 7), 1) for i in range(4000)] + [(9000, "other", "word", 1), (9001, None, "word", 1), (9002, "big", None, 1), (9003, "big", "", 1)],
        "doc_id bigint, source string, text string, rate int",
    )
    goal = spark.createDataFrame([("big", 0.6, 2), ("small", 0.4, 4), ("none", 0.0, 3)], "source string, target_share double, max_repeats int")
    training, shares = mixing.mix(docs, goal)
    got = {r.source: r for r in shares.collect()}
    assert abs(got["big"].actual_share - 0.6) < 0.02 and abs(got["small"].actual_share - 0.4) < 0.02
    assert got["none"].n_rows == 0
    used = training.groupBy("doc_id", "source").agg(F.count("*").alias("n"), F.max("copy").alias("m")).collect()
    assert {r.source for r in used} == {"big", "small"} and all(r.n == r.m <= {"big": 2, "small": 4}[r.source] for r in used)
    again, _ = mixing.mix(docs.repartition(7), goal)
    key = ["doc_id", "copy"]
    assert sorted(map(tuple, again.select(*key).collect())) == sorted(map(tuple, training.select(*key).collect()))
    assert mixing.mix(docs.limit(0), goal)[0].count() == 0
    assert mixing.mix(docs, goal.limit(0))[0].count() == 0


def test_training_set_holds_the_documents(spark):
    from tidewell.llm import queries

    got = queries.p9_training_set(spark, SMALL)
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert set(got.columns) == {*next(iter(docs.values())).asDict(), "n_tokens", "copy"}
    enc, seen = mixing._encoder(mixing.VOCABULARY), set()
    for r in got.collect():
        assert all(r[c] == v for c, v in docs[r.doc_id].asDict().items())
        assert r.n_tokens == len(enc.encode_ordinary(r.text or ""))
        seen.add((r.doc_id, r.copy))
    assert len(seen) == got.count() == sum(r.n_rows for r in queries.p9_shares(spark, SMALL).collect()) > 0
