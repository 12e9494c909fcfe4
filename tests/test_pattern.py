import random
import re

from acreledger.operators.pattern import like_join

from .conftest import values


def like(text, pattern):
    body = "".join(".*" if c == "%" else "." if c == "_" else re.escape(c) for c in pattern.lower())
    return re.fullmatch(body, text.lower(), re.S) is not None


def test_like_join_equals_nested_loop(spark):
    rng = random.Random(3)
    alphabet = "ab%_cB\\"
    texts = ["".join(rng.choice("abcABC \\") for _ in range(rng.randint(0, 6))) for _ in range(80)] + ["Jane Doe", "JANE DOE", "x", None]
    patterns = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 5))) for _ in range(60)] + [
        "jane doe", "%doe", "J_ne%", "%", "_", "%%", "__", "", None]
    t = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "id int, t string")
    p = spark.createDataFrame([(i, x) for i, x in enumerate(patterns)], "pid int, p string")
    got = values(like_join(t, "t", p, "p"), "id", "pid")
    want = [(i, j) for i, x in enumerate(texts) for j, y in enumerate(patterns)
            if x is not None and y is not None and like(x, y)]
    assert sorted(got) == sorted(want)


def test_no_nested_loop_in_plan(spark):
    t = spark.createDataFrame([(1, "Jane")], "id int, t string")
    p = spark.createDataFrame([(1, "j%")], "pid int, p string")
    plan = like_join(t, "t", p, "p")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_patterns_that_share_a_word_do_not_meet(spark):
    texts = [f"the {w} of the {v}" for w in ("barn", "silo", "truck") for v in ("north", "south", "creek")] + ["the", "other"]
    patterns = [f"%the {w}%" for w in ("barn", "silo", "truck", "plough")] + ["the%creek", "%of the north", "the _____ of%", "%the%", "%t_e%"]
    t = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "id int, t string")
    p = spark.createDataFrame([(i, x) for i, x in enumerate(patterns)], "pid int, p string")
    joined = like_join(t, "t", p, "p")
    got = values(joined, "id", "pid")
    assert sorted(got) == sorted((i, j) for i, x in enumerate(texts) for j, y in enumerate(patterns) if like(x, y))
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "min(struct" in plan  # the key is chosen by how many texts hold it


def test_clashing_columns_and_repeated_patterns(spark):
    t = spark.createDataFrame([(1, "Jane Doe"), (2, "jane doe"), (3, None)], "gram int, t string")
    p = spark.createDataFrame([(1, "jane%"), (2, "jane%"), (3, "JANE DOE"), (4, "%"), (5, "________")], "at int, p string")
    got = sorted(values(like_join(t, "t", p, "p"), "gram", "at"))
    assert got == [(i, j) for i in (1, 2) for j in (1, 2, 3, 4, 5)]
