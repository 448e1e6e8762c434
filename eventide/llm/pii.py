"""Personal data by bootstrapped contextual extraction, in DataFrame
functions only.

Base rules give the seed entities of four kinds; long mixed hexadecimal units
are seeds of a fifth, secrets. Every identifier-like unit of a text (a token with
a digit or an at sign, or a run of numbers) is an instance; the words around it
are its lexical patterns. Spark scores the pattern-instance graph in rounds: a
pattern is worth the share of its instances that are known entities of one kind,
an unseen instance is worth the noisy-or of the trusted patterns it occurs in,
and goes into the next round's pattern scores. A pattern that is trusted once
stays so, and rounds go on until no pattern is added. Secrets, and units in
trusted patterns at the end, are added to the base spans.

Positions are code points. They come from the pieces between matches
(``split``) and the matches (``regexp_extract_all``) of the same pattern.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, text_or_empty, written

KINDS = ("email", "ip", "card", "phone")
#: Added spans can be of these kinds.
SECRET = "secret"
ADDED_KINDS = (*KINDS, SECRET)
#: Seeds of secrets: long hexadecimal units with both digits and letters.
SECRET_RULE = r"^(?=[a-f]*[0-9])(?=[0-9]*[a-f])[0-9a-f]{32,}$"

#: The base rules. Possessive loops match the same strings as greedy ones here
#: (what follows a loop is never in its class) and cannot overflow the stack;
#: a look-behind, or the end of the last match, keeps a failing run of letters
#: from being tried again at each of its places.
RULES = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Identifier-like units.
UNIT = (r"(?:\G|(?<![A-Za-z0-9._%+-]))(?:[A-Za-z0-9._%+-]*+@[A-Za-z0-9.@-]*+|[+]?[0-9][0-9\x20().-]*[0-9](?![A-Za-z0-9])"
        r"|[A-Za-z._%+-]*+[0-9][A-Za-z0-9._%+-]*+)")
#: Code points on either side of a unit that its context words may reach over.
CONTEXT = 64

#: More rounds than any chain of patterns seen; reaching it is an error, not a result.
MOST_ROUNDS = 200
LEAST_SUPPORT = 5.0
LEAST_PRECISION = 0.8
LEAST_SCORE = 0.9

SPAN = "struct<start:int,end:int,word:string>"
UNIT_SPAN = "struct<start:int,end:int,word:string,before:string,after:string>"


def _empty(kind: str) -> Column:
    return F.expr(f"cast(array() as array<{kind}>)")


def _bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(sizes: Column) -> Column:
    """Sums of an array of numbers before each of its places."""
    zero = F.struct(F.lit(0).alias("at"), _empty("int").alias("out"))
    return F.aggregate(sizes, zero, lambda s, n: F.struct((s["at"] + n).alias("at"), F.concat(
        s["out"], F.array(s["at"])).alias("out")), lambda s: s["out"])


#: Numbers added up one by one; the sums of such runs are added up in turn, and
#: the sums of those, so that an array of n costs far less than its square.
RUN = 32


def _starts(sizes: Column, levels: int = 3) -> Column:
    """``_running`` for long arrays: within runs, and over the sums of runs."""
    if not levels:
        return _running(sizes)

    def whole(all_sizes: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(all_sizes) - 1) / RUN).cast("int")),
                           lambda b: F.slice(all_sizes, b * RUN + 1, RUN))
        return _bound(runs, lambda r: F.flatten(F.zip_with(
            r, _starts(F.transform(r, lambda own: F.aggregate(own, F.lit(0), lambda s, n: s + n)), levels - 1),
            lambda own, before: F.transform(_running(own), lambda n: n + before))))

    return F.when(F.size(sizes) == 0, _empty("int")).otherwise(_bound(sizes, whole))


def placed(text: Column, rule: str, asked: Column, context: bool = False) -> Column:
    """Matches of a rule with their places: array of (start, end, word), and
    with ``context`` the ends of the pieces on either side."""
    words = F.regexp_extract_all(text, F.lit(rule), 0)
    gaps = F.split(text, rule, -1)
    kind = SPAN if not context else UNIT_SPAN

    def found(x: Column) -> Column:
        def fields(start: Column, w: Column) -> list[Column]:
            return [start.alias("start"), (start + F.length(w["word"])).cast("int").alias("end"), w["word"].alias("word")]

        pairs = F.zip_with(F.slice(x["gaps"], 1, F.size(x["words"])), x["words"],
                           lambda g, w: F.struct(g.alias("gap"), w.alias("word")))
        begins = _starts(F.transform(pairs, lambda p: F.length(p["gap"]) + F.length(p["word"])))
        spans = F.zip_with(begins, pairs, lambda at, p: F.struct(
            *fields((at + F.length(p["gap"])).cast("int"), p),
            *([F.substring(p["gap"], -CONTEXT, CONTEXT).alias("before")] if context else [])))
        if not context:
            return spans
        behind = F.slice(x["gaps"], 2, F.size(x["words"]))
        return F.zip_with(spans, behind, lambda m, g: F.struct(
            m["start"].alias("start"), m["end"].alias("end"), m["word"].alias("word"), m["before"].alias("before"),
            F.substring(g, 1, CONTEXT).alias("after")))

    split = F.struct(words.alias("words"), gaps.alias("gaps"))
    none = _empty(kind)
    return F.when(asked, _bound(split, lambda x: F.when(F.size(x["words"]) > 0, found(x)).otherwise(none))).otherwise(none)


def digits(word: Column) -> Column:
    return F.regexp_replace(word, "[^0-9]", "")


def luhn(word: Column) -> Column:
    """The digits' check sum: every second digit from the right doubled."""
    number = F.reverse(digits(word))
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(number)), F.lit(0),
        lambda s, i: s + F.when(i % 2 == 1, number.substr(i, F.lit(1)).cast("int")).otherwise(
            F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]),
                         number.substr(i, F.lit(1)).cast("int") + 1)))
    return total % 10 == 0


def valid(kind: str, word: Column) -> Column:
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return word.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind == "card":
        return F.when(F.length(digits(word)).between(16, 19), luhn(word)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits(word)).between(8, 15)
    return F.lit(True)


def _checks(kind: str):
    return lambda m: valid(kind, m["word"])


#: Digits from which a number that is no card was meant as one.
CARD_LIKE = 12


def _fails(kind: str):
    """Matches that look like the kind and are not. A short number is not a bad card."""
    if kind == "card":
        return lambda m: ~valid(kind, m["word"]) & (F.length(digits(m["word"])) >= CARD_LIKE)
    return lambda m: ~valid(kind, m["word"])


def marked(docs: DataFrame) -> DataFrame:
    """Per row: id, doc_id, base spans by kind, matches that failed their
    check, and units with their context words. One scan of the texts."""
    text = F.col("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    asks = {"email": text.contains("@"), "phone": text.contains("+"),
            "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike(r"[0-9][\x20-]?[0-9]")}
    rows = rows.select("doc_id", "text", *[placed(text, RULES[k], asks[k]).alias(f"raw_{k}") for k in KINDS],
                       placed(text, UNIT, text.rlike("[0-9@]"), context=True).alias("units"))
    units = F.transform("units", lambda u: F.struct(
        u["start"].alias("start"), u["end"].alias("end"), F.lower(u["word"]).alias("word"),
        F.lower(F.regexp_extract(u["before"], r"(\S++)\s*+$", 1)).alias("left"),
        F.lower(F.regexp_extract(u["before"], r"(\S++\s++\S++)\s*+$", 1)).alias("left_two"),
        F.lower(F.regexp_extract(u["after"], r"^\s*+(\S++)", 1)).alias("right")))
    base = {k: F.filter(f"raw_{k}", _checks(k)) for k in KINDS}
    failed = F.concat(*[F.filter(f"raw_{k}", _fails(k)) for k in ("ip", "card", "phone")])
    places = lambda a: F.transform(a, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end")))
    return rows.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", *[places(base[k]).alias(k) for k in KINDS],
        places(failed).alias("failed"),
        units.alias("units"))


def instances(rows: DataFrame) -> DataFrame:
    """One row per unit: its kind if a base span overlaps it (the first kind
    listed) or it is a secret by rule, whether a failed match overlaps it, and
    its patterns.

    Spans sorted by start and units by end are swept once per document: a span
    of a kind overlaps a unit if one that began before the unit's end reaches
    beyond its start."""
    blank = {"word": F.lit(""), "left": F.lit(""), "left_two": F.lit(""), "right": F.lit("")}
    words = lambda of: [of(c).alias(c) for c in blank]

    def spans(name: str) -> Column:
        return F.transform(name, lambda m: F.struct(
            m["start"].alias("place"), F.lit(name).alias("span"), m["start"].alias("start"), m["end"].alias("end"),
            *words(blank.get)))

    units = F.transform("units", lambda u: F.struct(
        u["end"].alias("place"), F.lit("").alias("span"), u["start"].alias("start"), u["end"].alias("end"),
        *words(u.getField)))
    swept = rows.filter(F.size("units") > 0).select("row", F.inline(F.concat(units, *map(spans, (*KINDS, "failed")))))
    # at one place the unit that ends there comes before the span that begins there
    so_far = Window.partitionBy("row").orderBy("place", F.col("span") != "").rowsBetween(Window.unboundedPreceding, 0)
    reach = {k: F.max(F.when(F.col("span") == k, F.col("end"))).over(so_far) for k in (*KINDS, "failed")}
    met = swept.select("*", *[c.alias(f"reach_{k}") for k, c in reach.items()]).filter("span = ''")
    overlaps = lambda k: F.coalesce(F.col(f"reach_{k}") > F.col("start"), F.lit(False))
    kind = F.when(F.col("word").rlike(SECRET_RULE), F.lit(SECRET))
    for k in reversed(KINDS):
        kind = F.when(overlaps(k), F.lit(k)).otherwise(kind)
    pattern = lambda side, word: F.when(F.col(word) != "", F.concat(F.lit(side), word))
    patterns = F.array_compact(F.array(pattern("left:", "left"), pattern("two:", "left_two"), pattern("right:", "right")))
    return met.select("row", "start", "end", "word", kind.alias("kind"), overlaps("failed").alias("failed"),
                      patterns.alias("patterns"))


def _pattern_scores(graph: DataFrame, scores: DataFrame | None) -> DataFrame:
    """Trusted patterns with their kind and precision. ``graph`` has one row
    per (pattern, instance); ``scores`` the worth of unseen instances."""
    worth = {k: F.when(F.col("kind") == k, 1.0).otherwise(0.0) for k in ADDED_KINDS}
    if scores is not None:
        graph = graph.join(scores, "word", "left")
        unseen = F.col("kind").isNull() & ~F.col("failed")
        worth = {k: F.when(F.col("kind") == k, 1.0).when(
            unseen & (F.col("scored_kind") == k), F.coalesce("score", F.lit(0.0))).otherwise(0.0) for k in ADDED_KINDS}
    sums = graph.groupBy("pattern").agg(F.count("*").alias("n"), *[F.sum(worth[k]).alias(k) for k in ADDED_KINDS])
    best = F.greatest(*[F.struct(F.col(k).alias("worth"), F.lit(k).alias("kind")) for k in ADDED_KINDS])
    return sums.select("pattern", (best["worth"] / F.col("n")).alias("precision"), best["worth"].alias("support"),
                       best["kind"].alias("pattern_kind")).filter(
        (F.col("support") >= LEAST_SUPPORT) & (F.col("precision") >= LEAST_PRECISION)).select(
        "pattern", "precision", "pattern_kind")


def _noisy_or(found: DataFrame, *by: str) -> DataFrame:
    """Worth of instances from the trusted patterns they occur in, and the
    kind that most of it comes from (ties: the first in the alphabet)."""
    miss = F.when(F.col("precision") >= 1.0, F.lit(1e-9)).otherwise(1 - F.col("precision"))
    per_kind = found.groupBy(*by, "pattern_kind").agg((1 - F.exp(F.sum(F.log(miss)))).alias("score"))
    top = F.max(F.struct("score", "pattern_kind"))
    return per_kind.groupBy(*by).agg(top.alias("top")).select(
        *by, F.col("top.score").alias("score"), F.col("top.pattern_kind").alias("scored_kind"))


def discovered(rows: DataFrame) -> DataFrame:
    """Added spans: row, kind, start, end."""
    units = written(instances(rows), "pii-units")
    graph = written(
        units.select("word", "kind", "failed", F.explode("patterns").alias("pattern")).groupBy("pattern", "word").agg(
            F.max("kind").alias("kind"), F.max("failed").alias("failed")), "pii-graph")
    unseen = graph.filter("kind is null and not failed")
    trusted = written(_pattern_scores(graph, None), "pii-patterns")
    n = trusted.count()
    for _ in range(MOST_ROUNDS):
        scores = _noisy_or(unseen.join(trusted, "pattern"), "word")
        now = _pattern_scores(graph, scores).withColumnsRenamed({"precision": "new", "pattern_kind": "new_kind"})
        trusted = written(trusted.join(now, "pattern", "full").select(
            "pattern", F.greatest("precision", "new").alias("precision"),
            F.coalesce("pattern_kind", "new_kind").alias("pattern_kind")), "pii-patterns")
        before, n = n, trusted.count()
        if n == before:
            break
    else:
        raise RuntimeError(f"patterns were still being added after {MOST_ROUNDS} rounds")
    found = units.filter("kind is null and not failed").select(
        "row", "start", "end", F.explode("patterns").alias("pattern")).join(trusted, "pattern")
    by_pattern = _noisy_or(found, "row", "start", "end").filter(F.col("score") >= LEAST_SCORE).select(
        "row", F.col("scored_kind").alias("kind"), "start", "end")
    return units.filter(F.col("kind") == SECRET).select("row", "kind", "start", "end").unionByName(by_pattern)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(
        F.array(*map(F.lit, ADDED_KINDS)), s["kind"] + 1), s["start"], s["end"])), ",")


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256 and
    spans (base and added) per row of ``docs``.

    A null text is empty: no spans. Rows repeated, or without doc_id, are rows
    of their own; equal units count once in pattern scores. An empty table
    gives no rows. Only doc_id and text are read."""
    rows = written(marked(docs), "pii")
    of_kind = lambda spans, i: F.transform(spans, lambda s: F.struct(
        F.lit(i).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    base = F.concat(*[of_kind(F.col(k), i) for i, k in enumerate(KINDS)])
    place = {k: i for i, k in enumerate(ADDED_KINDS)}
    number = F.lit(0)
    for k, i in place.items():
        number = F.when(F.col("kind") == k, F.lit(i)).otherwise(number)
    added = discovered(rows).groupBy("row").agg(F.collect_list(F.struct(
        number.alias("kind"), F.col("start"), F.col("end"))).alias("added"))
    none = _empty("struct<kind:int,start:int,end:int>")
    return rows.join(added, "row", "left").select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
        _listed(F.array_sort(F.concat(base, F.coalesce("added", none)))).alias("spans"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))
