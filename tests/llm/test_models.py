import math
import random

from acreledger.llm.secrets import FEATURES, candidates, describe, held_out_counts, pair_scores, scan_secrets, table_words
from acreledger.llm.toxicity import CATEGORIES, apply_chain, judge_toxicity, labelled_documents, train_chain

from .helpers import ROWS, awkward, empty


def corpus(rng, n):
    rows = []
    for i in range(n):
        text = [rng.choice("stone river cloud green apple window paper garden music road".split()) + rng.choice(["", "s", "ed"]) for _ in range(60)]
        bad = i % 5 == 0
        if bad:
            for _ in range(3):
                text[rng.randrange(60)] = rng.choice(["idiot", "moron", "scum"]) if i % 2 else "zorbl" + rng.choice("abcdef")
        rows.append((i, " ".join(text), "en", "s", int(bad)))
    return rows


def test_held_out_accuracy_of_the_chain(spark):
    rows = corpus(random.Random(1), 900)
    docs = spark.createDataFrame([r[:4] for r in rows], "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(r[0], r[4]) for r in rows if r[0] % 3] + [(None, 1), (1, None)], "doc_id long, toxic int")
    chain = train_chain(labelled_documents(docs, labels), CATEGORIES, steps=15)
    assert [len(w) - len(chain.features) for w, _ in chain.models] == [0, 1, 2]  # later models see earlier ones
    found = {r["doc_id"]: r for r in apply_chain(docs, chain).collect()}
    held = [r for r in rows if r[0] % 3 == 0]
    assert sum((found[r[0]]["p_toxic"] >= 0.5) == bool(r[4]) for r in held) >= 0.99 * len(held)
    for r in held:
        if r[4]:
            assert (found[r[0]]["p_insult"] > found[r[0]]["p_other"]) == bool(r[0] % 2)
    again = apply_chain(awkward(spark, clashes=True), chain)
    assert again.count() == len(ROWS) and again.filter("p_toxic IS NULL").count() == 0
    assert apply_chain(empty(spark), chain).count() == 0


def test_labels_of_no_use(spark):
    docs = awkward(spark, clashes=True)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r["toxic"] for r in judge_toxicity(docs, none).collect()] == [False] * len(ROWS)
    clean = spark.createDataFrame([(1, 0), (2, 0), (7, 0)], "doc_id long, toxic int")
    assert not any(r["toxic"] for r in judge_toxicity(docs, clean).collect())
    assert judge_toxicity(empty(spark), none).count() == 0


def test_candidates_have_their_places(spark):
    text = "é key = 'AAAA1111bbbb2222' and AAAA1111bbbb2222 then " + "q" * 40 + " 1234567890123456-7"
    docs = awkward(spark, [*ROWS, (30, text, "en", "a/test.py")])
    found = candidates(docs).collect()
    assert [(r["doc_id"], r["finding"]) for r in found] == [(30, "AAAA1111bbbb2222"), (30, "AAAA1111bbbb2222"), (30, "1234567890123456-7")]
    assert all(text[r["start"] - 1 : r["start"] - 1 + len(r["finding"])] == r["finding"] for r in found)
    assert found[0]["before"].endswith("= '") and found[0]["after"].startswith("'") and found[0]["path"] == "a/test.py"
    assert describe(candidates(empty(spark)), table_words(empty(spark))).count() == 0


def test_forest_tells_secrets_from_numbers(spark):
    rng = random.Random(4)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    rows = []
    for i in range(240):
        secret = i % 2 == 0
        value = hexes(39) + "f" if secret else "".join(rng.choice("0123456789") for _ in range(16))
        before = f'token = "{value}" there' if secret else f"card {value} paid"
        rows.append((i, f"some words {before} and more", "en", "src"))
    found = {r["doc_id"]: r["secret"] for r in scan_secrets(awkward(spark, rows)).collect()}
    assert found == {i: i % 2 == 0 for i in range(240)}
    only = scan_secrets(awkward(spark, rows[:1]))
    assert [(r["p_secret"], r["secret"]) for r in only.collect()] == [(None, True)]
    assert scan_secrets(empty(spark)).count() == 0


def test_short_and_odd_values_are_candidates(spark):
    texts = {
        40: ('password = "p@ss:w0rd!" end', "p@ss:w0rd!"),
        41: ("db_password: hunter and more", "hunter"),
        42: ('{"api_key": "abc.def.ghi"}', "abc.def.ghi"),
        43: ("see postgres://me:s3c:ret@host/db", "s3c:ret"),
        44: ("secret 'correct horse' there", "correct horse"),
        45: ("code x7 there", "x7"),
        46: ("word aBcDeFgH there", "aBcDeFgH"),
        47: ("Authorization: Bearer abcdef there", "abcdef"),
    }
    docs = awkward(spark, [(i, text, "en", "a") for i, (text, _) in texts.items()])
    found = describe(candidates(docs), table_words(docs)).collect()
    assert {r["doc_id"]: r["finding"] for r in found} == {i: value for i, (_, value) in texts.items()} and len(found) == len(texts)
    assert all(texts[r["doc_id"]][0][r["start"] - 1 :].startswith(r["finding"]) for r in found)


def test_dictionary_and_letter_pairs_come_from_the_table(spark):
    rows = [(i, "the stone Stone near_by x12 stone", "en", "a") for i in range(3)] + [(9, "rare " + "z" * 30, "en", "a"), (10, None, "en", "a")]
    docs = awkward(spark, rows)
    words = table_words(docs)
    assert {(r["word"], r["docs"]) for r in words.collect()} == {("the", 3), ("stone", 3)}
    scores = pair_scores(words)
    place = lambda pair: 26 * (ord(pair[0]) - 97) + ord(pair[1]) - 97
    assert len(scores) == 676 and abs(scores[place("st")] - math.log(4 / 29)) < 1e-12 and abs(scores[place("qz")] - math.log(1 / 26)) < 1e-12
    found = describe(candidates(awkward(spark, [(1, "key stoneQx7 there", "en", "a")])), words).first()
    usual = [scores[place(p)] for p in ("st", "to", "on", "ne", "eq", "qx")]
    assert abs(found["f_cover"] - 5 / 7) < 1e-12 and abs(found["f_bigrams"] - sum(usual) / 6) < 1e-9


def test_held_out_findings_and_clashing_columns(spark):
    rng = random.Random(6)
    rows = []
    for i in range(300):
        hexes = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        number = "".join(rng.choice("0123456789") for _ in range(rng.choice([4, 16])))
        rows.append((i, f'so the token = "{hexes}" was read' if i % 3 == 0 else f"card {number} paid by mail{i % 7} here", "en", "src"))
    docs = awkward(spark, rows, clashes=True)
    for name in ("_row", "_known", "_found", "_usual", "word", "docs", "v", "probability", "label", "f_length", "secret"):
        docs = docs.selectExpr("*", f"'own' AS {name}")
    found = describe(candidates(docs), table_words(docs))
    counts = {(r["label"], r["secret"]): r["n"] for r in held_out_counts(found).collect()}
    assert set(counts) == {(1.0, True), (0.0, False)}
    scanned = scan_secrets(docs)
    assert {c.lower() for c in docs.columns} - {"text"} <= set(scanned.columns) and set(FEATURES) <= set(scanned.columns)
    assert {r["_row"] for r in scanned.collect()} == {"own"}
    assert {r["doc_id"] for r in scanned.filter("secret").collect()} == {i for i in range(300) if i % 3 == 0}
