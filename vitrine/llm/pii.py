"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Entities that the base patterns prove (mail addresses, network addresses, card and phone numbers) are
the seeds. The words around them are lexical patterns; tokens with enough digits are the instances
that patterns may extract. Spark scores the graph of patterns and instances in rounds: a pattern is
as good as the share of its instances that are known, an instance becomes known through good
patterns. What good patterns extract beyond the seeds is added as spans of kind "context".
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm.storage import stored

KINDS = ("email", "ip", "card", "phone", "context")
LEAST_KNOWN = 3  # known instances that a pattern must extract
LEAST_SCORE = 0.7  # of a pattern
LEAST_CONFIDENCE = 0.9  # of an instance
LEAST_DIGITS = 5  # of an instance

# The base patterns. Possessive forms and look-behinds take away backtracking and starts inside a run
# that can only fail again; the matches are those of the plain patterns. \G is the last match's end.
_EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
_CARD = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_RUN = r"[A-Za-z0-9._%+@/-]"
_TOKEN = rf"(?<!{_RUN})(?:(?![0-9]){_RUN})*+[0-9]{_RUN}*+"

# The last words of a gap, whole: they start at its start or after white space, and are read once.
_ONE_BEFORE = r"(?<!\S)\S++\s*+$"
_TWO_BEFORE = r"(?<!\S)\S++\s++\S++\s*+$"

_BLOCK = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with `value` computed once: lambdas compute what they refer to again for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(values: Column, zero: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """Running fold of an array of longs. In blocks, so that appending stays cheap on long arrays."""

    def scan(part: Column) -> Column:
        full = F.aggregate(part, F.array(zero), lambda acc, x: F.array_append(acc, merge(F.element_at(acc, -1), x)))
        return F.slice(full, F.lit(2), F.lit(_BLOCK))

    def in_blocks(v: Column) -> Column:
        n_blocks = F.ceil(F.size(v) / F.lit(_BLOCK)).cast("int")
        return F.transform(F.sequence(F.lit(1), n_blocks), lambda b: scan(F.slice(v, (b - 1) * _BLOCK + 1, F.lit(_BLOCK))))

    def before(blocks: Column) -> Column:
        folds = F.aggregate(
            blocks, F.array(zero), lambda acc, x: F.array_append(acc, merge(F.element_at(acc, -1), F.element_at(x, -1)))
        )
        return F.slice(folds, F.lit(1), F.size(blocks))

    def joined(blocks: Column) -> Column:
        return F.flatten(
            F.zip_with(blocks, before(blocks), lambda block, fold: F.transform(block, lambda x: merge(fold, x)))
        )

    empty = F.array().cast("array<bigint>")
    return let(values, lambda v: F.when(F.size(v) > 0, let(in_blocks(v), joined)).otherwise(empty))


def _add(a: Column, b: Column) -> Column:
    return a + b


def matches(found: Column, between: Column) -> Column:
    """Array of (start, end, value) in code points from all matches and what lies between them."""
    widths = F.zip_with(
        F.slice(between, F.lit(1), F.size(found)), found, lambda gap, m: (F.length(gap) + F.length(m)).cast("long")
    )
    return F.zip_with(
        running(widths, F.lit(0).cast("long"), _add),
        found,
        lambda end, m: F.struct((end - F.length(m)).alias("start"), end.alias("end"), m.alias("value")),
    )


def _all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True if the check digit of a digit string fits."""

    def term(i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i + 1, F.lit(1)).cast("int") * (1 + (i + 1) % 2)
        return F.floor(d / 10).cast("int") + d % 10

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda acc, i: acc + term(i))
    return total % 10 == 0


def _part_fits(part: Column) -> Column:
    value = F.regexp_replace(part, "^0+", "")
    return F.when(value == "", True).when(F.length(value) <= 3, value.cast("int") <= 255).otherwise(False)


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), _part_fits)
    if kind == "card":
        return let(_digits(value), lambda d: F.when(F.length(d).between(14, 19), luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


_BASE = {"email": (_EMAIL, "@"), "ip": (_IP, None), "card": (_CARD, None), "phone": (_PHONE, "+")}


def _context(gap: Column, after: Column) -> Column:
    """Hashes of the lexical patterns around an occurrence: two words before; a word on each side."""

    def plain(c: Column) -> Column:
        return F.trim(F.lower(F.regexp_replace(F.regexp_replace(c, "[0-9]", "0"), r"\s+", " ")))

    two = plain(F.regexp_extract(gap, _TWO_BEFORE, 0))
    left = plain(F.regexp_extract(gap, _ONE_BEFORE, 0))
    right = plain(F.regexp_extract(after, r"^\s*+\S++", 0))
    return F.array(
        F.when(two != "", F.xxhash64(F.lit("before"), two)),
        F.when((left != "") & (right != ""), F.xxhash64(F.lit("around"), left, right)),
    )


def _spans_of(kind: str, order: int, found: Column) -> Column:
    good = F.filter(found, lambda m: _valid(kind, m["value"]))
    return F.transform(
        good, lambda m: F.struct(m["start"].alias("start"), F.lit(order).alias("kind"), m["end"].alias("end"))
    )


def _scanned(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, key (hash of the text), base spans, and token occurrences with their contexts."""
    df = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    digit = F.col("text").rlike("[0-9]")
    none = F.array().cast("array<string>")
    for kind, (pattern, sign) in {**_BASE, "token": (_TOKEN, None)}.items():
        may = F.col("text").contains(sign) if sign else digit
        df = df.withColumn(f"{kind}_all", F.when(may, _all(F.col("text"), pattern)).otherwise(none))
    spans = []
    for order, (kind, (pattern, _)) in enumerate(_BASE.items()):
        some = F.size(f"{kind}_all") > 0
        found = matches(F.col(f"{kind}_all"), F.split("text", pattern, -1))
        spans.append(F.when(some, _spans_of(kind, order, found)).otherwise(F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")))
    gaps = F.split("text", _TOKEN, -1)
    around = F.zip_with(
        "gaps", F.slice("gaps", F.lit(2), F.size("gaps")), lambda gap, after: F.struct(gap.alias("gap"), after.alias("after"))
    )
    found = F.zip_with(matches(F.col("token_all"), F.col("gaps")), around, lambda m, a: F.struct(m.alias("m"), a.alias("a")))
    tokens = F.filter(found, lambda t: F.length(_digits(t["m"]["value"])) >= LEAST_DIGITS)
    tokens = F.transform(
        tokens,
        lambda t: F.struct(
            t["m"]["start"].alias("start"), t["m"]["end"].alias("end"), F.xxhash64(t["m"]["value"]).alias("instance"),
            _context(t["a"]["gap"], t["a"]["after"]).alias("patterns"),
        ),
    )
    kind_of = "array<struct<start:bigint,end:bigint,instance:bigint,patterns:array<bigint>>>"
    return df.withColumn("gaps", F.when(F.size("token_all") > 0, gaps)).select(
        "doc_id",
        F.xxhash64("text").alias("key"),
        F.array_sort(F.concat(*spans)).alias("base"),
        F.when(F.size("token_all") > 0, tokens).otherwise(F.array().cast(kind_of)).alias("tokens"),
    )


def _covered(scanned: DataFrame) -> DataFrame:
    """One row a token occurrence; `seed` if a base span covers it."""
    none = F.lit(None).cast("bigint")
    base = F.transform(
        "base",
        lambda b: F.struct(
            b["start"].alias("start"), F.lit(0).alias("is_token"), b["end"].alias("end"), none.alias("instance"),
            F.array().cast("array<bigint>").alias("patterns"),
        ),
    )
    tokens = F.transform(
        "tokens",
        lambda t: F.struct(
            t["start"].alias("start"), F.lit(1).alias("is_token"), t["end"].alias("end"), t["instance"].alias("instance"),
            t["patterns"].alias("patterns"),
        ),
    )
    # in order of their starts, a token is covered if a base span before it reaches its end
    reach = running(
        F.transform("events", lambda e: F.when(e["is_token"] == 0, e["end"]).otherwise(F.lit(-1).cast("long"))),
        F.lit(-1).cast("long"),
        lambda a, b: F.greatest(a, b),
    )
    rows = F.filter(
        F.zip_with("events", reach, lambda e, r: F.struct(e.alias("token"), (r >= e["end"]).alias("seed"))),
        lambda x: x["token"]["is_token"] == 1,
    )
    return (
        scanned.filter(F.size("tokens") > 0)
        .select("doc_id", "key", F.array_sort(F.concat(base, tokens)).alias("events"))
        .select("doc_id", "key", F.explode(rows).alias("row"))
        .select("doc_id", "key", "row.token.start", "row.token.end", "row.token.instance", "row.token.patterns", "row.seed")
    )


def _good_patterns(edges: DataFrame) -> DataFrame:
    """pattern, score: the share of a pattern's instances that are known, where it suffices."""
    return (
        edges.groupBy("pattern")
        .agg(F.sum(F.col("known").cast("long")).alias("known"), F.count("*").alias("n"))
        .withColumn("score", F.col("known") / F.col("n"))
        .filter((F.col("known") >= LEAST_KNOWN) & (F.col("score") >= LEAST_SCORE))
        .select("pattern", "score")
    )


def bootstrap(occurrences: DataFrame) -> DataFrame:
    """The good patterns (pattern, score) of the pattern-instance graph, scored until nothing changes.

    What is known only grows: a pattern that was good once stays among the sources of its instances, so the
    rounds end when neither side has gained anything. Only two counts a round reach the driver.
    """
    edges = stored(
        occurrences.select(F.explode("patterns").alias("pattern"), "instance", "seed")
        .filter("pattern is not null")
        .groupBy("pattern", "instance")
        .agg(F.max("seed").alias("known")),
        "pii-edges",
    )
    current, before = edges, (-1, -1)
    while True:
        good = stored(_good_patterns(current), "pii-patterns")
        n_good = good.count()
        if not n_good:
            return good
        doubt = F.sum(F.log(F.greatest(1 - F.col("score"), F.lit(1e-9))))
        learned = stored(
            edges.join(good, "pattern").groupBy("instance").agg(doubt.alias("doubt"))
            .filter(F.exp("doubt") <= 1 - LEAST_CONFIDENCE).select(F.col("instance").alias("of")),
            "pii-instances",
        )
        now = (n_good, learned.count())
        if now == before:
            return good
        before = now
        current = edges.join(learned, edges.instance == learned.of, "left").select(
            "pattern", "instance", (F.col("known") | F.col("of").isNotNull()).alias("known")
        )


def _text_of(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_context for every document.

    Offsets are code points, ends exclusive. Null and empty texts have no spans. Spans depend on the
    text and the whole corpus only, so repeated rows give repeated results; null ids are kept; an empty
    table gives an empty one; other columns are ignored.
    """
    scanned = stored(_scanned(docs, id_col, text_col), "pii-scanned")
    occurrences = stored(_covered(scanned), "pii-tokens")
    good = bootstrap(occurrences)
    open_ = occurrences.filter(~F.col("seed")).select(
        F.col("doc_id").alias("of_doc"), F.col("key").alias("of_key"), F.explode("patterns").alias("pattern"),
        F.struct("start", F.lit(len(KINDS) - 1).alias("kind"), "end").alias("span"),
    )
    added = open_.join(good, "pattern").groupBy("of_doc", "of_key").agg(F.collect_set("span").alias("added"))
    base = F.col("base")
    both = F.when(F.col("added").isNull(), base).otherwise(F.array_sort(F.concat(base, F.col("added"))))
    count = lambda k: F.size(F.filter(base, lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    joined = scanned.select("doc_id", "key", "base").join(
        added, F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("key") == F.col("of_key")), "left"
    )
    return joined.select(
        "doc_id",
        *[count(k) for k in range(4)],
        F.sha2(_text_of(base), 256).alias("base_sha256"),
        _text_of(both).alias("spans"),
        F.coalesce(F.size("added"), F.lit(0)).cast("long").alias("n_context"),
    )
