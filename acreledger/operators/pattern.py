"""Join on a LIKE pattern held in a column (J5, F5) as an equi join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _grams(text: Column, size: int) -> Column:
    starts = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - size + 1))
    return F.coalesce(
        F.transform(starts, lambda i: F.substring(text, i, F.lit(size))), F.array().cast("array<string>")
    )


#: Groups over which patterns without any letter are dealt, as they match nearly every text.
SALTS = 16


def _literal_grams(p: Column) -> Column:
    """``gram, at, fixed`` of a lower-case pattern: each piece of up to three characters of its literal runs.

    ``at`` is the least place it can have in a text, ``fixed`` that it has no other (no % before it).  Runs
    shorter than three are one piece.
    """
    runs = F.regexp_extract_all(p, F.lit("[^%_]+|%|_"), F.lit(0))
    start = F.struct(F.array().cast("array<struct<gram:string,at:int,fixed:boolean>>").alias("all"), F.lit(1).alias("at"), F.lit(True).alias("fixed"))

    def step(a: Column, run: Column) -> Column:
        last = F.greatest(F.length(run) - 2, F.lit(1))
        pieces = F.transform(
            F.sequence(F.lit(1), last),
            lambda i: F.struct(F.substring(run, i, F.lit(3)).alias("gram"), (a["at"] + i - 1).alias("at"), a["fixed"].alias("fixed")),
        )
        many, one = run == "%", run == "_"
        return F.struct(
            F.when(many | one, a["all"]).otherwise(F.concat(a["all"], pieces)).alias("all"),
            F.when(many, a["at"]).otherwise(a["at"] + F.length(run)).alias("at"),
            (a["fixed"] & ~many).alias("fixed"),
        )

    return F.aggregate(runs, start, step, lambda a: a["all"])


def like_join(texts: DataFrame, text: str, patterns: DataFrame, pattern: str) -> DataFrame:
    """``texts`` inner joined to ``patterns`` where text LIKE pattern, ignoring case.

    A plain theta join compares every text with every pattern.  Here each pattern is keyed by one piece of its literal
    runs: of all its pieces (three characters, where a run has as many) the one that the fewest distinct texts hold,
    so patterns that share a common word do not meet in one task.  Distinct texts offer those of
    their pieces that are keys; place before LIKE: a piece must stand where the pattern can have it.  The LIKE itself decides,
    and the matches go back to the rows by text.  Nothing is missed: a text that matches a pattern contains
    each piece of it, so a pattern with a piece that no text has matches none.  Patterns without wildcards
    are equal texts; those without letters are dealt apart.
    """
    own = [F.col(f"`{c}`") for c in patterns.columns]
    p, t = F.lower(F.col(f"`{pattern}`")), F.lower(F.col("_text"))
    listed = patterns.where(F.col(f"`{pattern}`").isNotNull()).select(F.struct(*own).alias("_row"), p.alias("_p"))
    has_wildcard, has_letter = F.col("_p").rlike("[%_]"), F.col("_p").rlike("[^%_]")
    distinct_texts = texts.where(F.col(f"`{text}`").isNotNull()).select(F.col(f"`{text}`").alias("_text")).distinct()

    # a piece of three is rarer than a shorter one and is preferred; shorter ones serve patterns that have no other
    pieces = listed.select("_p").distinct().where(has_wildcard & has_letter).select("_p", F.inline(_literal_grams(F.col("_p"))))
    longest = F.max(F.length("gram")).over(Window.partitionBy("_p"))
    pieces = pieces.withColumn("_most", longest).where(F.length("gram") == F.col("_most")).drop("_most")
    offered = distinct_texts.select("_text", t.alias("_t"), F.explode(F.array_distinct(F.concat(*[_grams(t, n) for n in (1, 2, 3)]))).alias("gram"))
    offered = offered.join(pieces.select("gram").distinct(), "gram", "left_semi")
    held = offered.groupBy("gram").agg(F.count(F.lit(1)).alias("texts"))
    rarest = pieces.join(held, "gram", "left").groupBy("_p").agg(F.min(F.struct(F.coalesce("texts", F.lit(0)).alias("texts"), "gram", "at", "fixed")).alias("key"))
    keyed = rarest.where("key.texts > 0").select("_p", "key.gram", "key.at", "key.fixed")
    place = F.when(F.col("fixed"), F.col("_t").substr(F.col("at"), F.length("gram")) == F.col("gram"))
    place = place.otherwise(F.length("_t") - F.call_function("locate", F.reverse("gram"), F.reverse("_t")) - F.length("gram") + 2 >= F.col("at"))
    found = offered.join(keyed, "gram").where(place).select("_text", "_p")

    equal = distinct_texts.join(listed.where(~has_wildcard).select("_p").distinct(), t == F.col("_p")).select("_text", "_p")
    open_ = listed.where(has_wildcard & ~has_letter).select("_p").distinct().withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = distinct_texts.withColumn("_salt", F.pmod(F.xxhash64("_text"), F.lit(SALTS)).cast("int"))
    open_ = salted.join(open_, "_salt").select("_text", "_p")

    # a control character as escape leaves backslashes in patterns literal
    candidates = found.unionByName(open_).where(F.expr(f"_text ilike _p escape '{chr(1)}'")).unionByName(equal)
    matched = candidates.join(listed, "_p").select(F.col("_text").alias(text), "_row.*")
    return texts.join(matched, text)
