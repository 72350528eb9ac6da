"""Personal data by patterns and by bootstrapping, with DataFrame functions only.

Seeds are the matches of fixed patterns (e-mail and IP addresses, card and phone numbers), whatever white space they hold. They and every
identifier-like token or run of digit groups are instances; the word before it, and the two words before it, are its lexical patterns. The graph of patterns and instances is scored in rounds: a
pattern is as good as its instances on average, an instance as its best patterns together. Tokens behind patterns of high
confidence are found too, though no fixed pattern knows them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableloom.session import freeze

# The patterns of the base kinds. Possessive loops and a look behind keep them linear on long runs:
# a match can begin only where a run begins, or where the match before it ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

#: A token with a digit, or with an @ inside, up to white space.
TOKEN = r"(?<!\S)(?:[^\s0-9]*+[0-9]\S*+|[^\s@]++@\p{L}\S*+)"

#: Two or more digit groups with a space between.
GROUPS = r"(?<!\S)[^\s\p{L}\p{N}]*+[0-9][0-9().-]*+(?:\x20[(]?[0-9][0-9().-]*+(?=[^\s\p{L}\p{N}]*+(?!\S)))++"

#: Characters and digits of an identifier-like token; one with an @ needs no digits.
TOKEN_SIZE, TOKEN_DIGITS = (6, 64), 3

ROUNDS = 3
MIN_SEEDS = 5
CONFIDENT = 0.8

KINDS = ("email", "ip", "card", "phone", "found")

_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


def _matches(text: Column, pattern: str, only: Column) -> Column:
    """``start, end, match`` of all matches, in code points. The pieces between matches give the places of the matches."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("match"))
    empty = F.array().cast("array<struct<start:int,end:int,match:string,gap:string>>")

    def step(acc, x):
        start = acc["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["match"]), F.lit(0))
        span = F.struct(start.alias("start"), end.alias("end"), x["match"].alias("match"), x["gap"].alias("gap"))
        return F.struct(end.alias("at"), F.array_append(acc["spans"], span).alias("spans"))

    spans = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), empty.alias("spans")), step)["spans"]
    return F.when(only, F.filter(spans, lambda s: s["match"].isNotNull())).otherwise(empty)


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(c: Column) -> Column:
    size = F.length(_digits(c))

    def add(acc, i):
        digit = F.substring(_digits(c), size - i + 1, F.lit(1)).cast("int")
        twice = digit * 2
        return acc + F.when(i % 2 == 1, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(1), size), F.lit(0), add) % 10 == 0


def _base(text: Column) -> dict[str, Column]:
    """Spans of each kind that pass its test."""
    has_digit = text.rlike("[0-9]")
    ip = lambda s: s["match"].rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    card = lambda s: F.when(F.length(_digits(s["match"])).between(16, 19), _luhn(s["match"])).otherwise(False)
    phone = lambda s: F.length(_digits(s["match"])).between(8, 15)
    return {
        "email": _matches(text, EMAIL, F.contains(text, F.lit("@"))),
        "ip": F.filter(_matches(text, IP, has_digit), ip),
        "card": F.filter(_matches(text, CARD, has_digit), card),
        "phone": F.filter(_matches(text, PHONE, F.contains(text, F.lit("+"))), phone),
    }


def _words_before(gap: Column) -> Column:
    """The words of the text before an instance, back to the token before with a digit or an @."""
    near = F.regexp_replace(gap, r"(?s)^.*(?:[0-9]|\S@\p{L})\S*", "")
    return F.filter(F.split(F.lower(near), r"[^\p{L}]+"), lambda w: w != "")


def _overlaps(spans: Column, t: Column) -> Column:
    return F.exists(spans, lambda b: (b["start"] < t["end"]) & (b["end"] > t["start"]))


def _instance(start: Column, end: Column, token: Column, gap: Column) -> Column:
    return F.struct(start.alias("start"), end.alias("end"), token.alias("token"), _contexts(_words_before(gap)).alias("contexts"))


def _seeds(spans: Column) -> Column:
    """The spans of a base kind as instances."""
    return F.transform(spans, lambda s: _instance(s["start"], s["end"], s["match"], s["gap"]))


def _cores(text: Column, pattern: str, lead: str) -> Column:
    """Matches without what leads and trails, if they are identifier-like: where they are, their text and their patterns."""

    def cut(s):
        front = F.regexp_replace(s["match"], lead, "")
        core = F.regexp_replace(front, r"[^\p{L}\p{N}]+$", "")
        start = s["start"] + F.length(s["match"]) - F.length(front)
        return _instance(start, start + F.length(core), core, s["gap"])

    shaped = lambda t: (F.length(_digits(t["token"])) >= TOKEN_DIGITS) | t["token"].contains("@")
    return F.filter(F.transform(_matches(text, pattern, text.rlike("[0-9@]")), cut), lambda t: F.length(t["token"]).between(*TOKEN_SIZE) & shaped(t) & (F.size(t["contexts"]) > 0))


def _contexts(words: Column) -> Column:
    """The last word, and the last two; whichever there are."""
    last = lambda n: F.array_join(F.slice(words, F.greatest(F.size(words) - (n - 1), F.lit(1)), F.lit(n)), " ")
    return F.when(F.size(words) == 0, F.array().cast("array<string>")).when(F.size(words) == 1, F.array(last(1))).otherwise(F.array(last(1), last(2)))


def confident_patterns(edges: DataFrame) -> DataFrame:
    """``context`` of the patterns of high confidence in a graph of ``context, token, seed``, a row for each pair.

    Each round is a sum by pattern and one by token, folded on the map side; no pattern's instances are gathered.
    """
    known = edges.select("context", "token", "seed", F.when(F.col("seed"), 1.0).otherwise(0.0).alias("trust"))
    patterns = None
    for i in range(ROUNDS):
        patterns = known.groupBy("context").agg(
            (F.sum("trust") / F.count(F.lit(1))).alias("confidence"), F.sum(F.col("seed").cast("int")).alias("seeds")
        ).where(f"seeds >= {MIN_SEEDS}")
        if i < ROUNDS - 1:
            patterns = freeze(patterns, "patterns")
            # a token is trusted unless all its patterns fail: one minus the product of what they leave
            doubt = F.sum(F.log1p(-0.99 * F.coalesce("confidence", F.lit(0.0))))
            tokens = edges.where("NOT seed").join(patterns, "context").groupBy("token").agg((1 - F.exp(doubt)).alias("trusted"))
            known = freeze(
                edges.join(tokens, "token", "left").select(
                    "context", "token", "seed", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("trusted", F.lit(0.0))).alias("trust")
                ),
                "trust",
            )
    return patterns.where(F.col("confidence") >= CONFIDENT).select("context")


def find_personal_data(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Each row as ``row`` with ``base`` and ``spans``, arrays of ``kind, start, end`` (code points, end exclusive) in the order of
    ``KINDS`` and of start; ``spans`` has the base spans and those that bootstrapping found.

    A base span is an instance with the words before it; a token that overlaps one is none of its own.
    Null texts count as empty and have no spans. Kinds are matched apart from each other, so their spans may overlap; a found
    token never overlaps a base span. Repeated rows get equal results; an empty table gives no rows.
    """
    columns = [F.col(f"`{c}`") for c in (keep if keep is not None else docs.columns)]
    source = docs.select(F.struct(*columns).alias("row"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    kinds = _base(F.col("text"))
    found = source.select(
        "row", *(c.alias(k) for k, c in kinds.items()), _cores(F.col("text"), GROUPS, r"^[^\p{N}+(]+").alias("groups"),
        _cores(F.col("text"), TOKEN, r"^[^\p{L}\p{N}+]+").alias("single"),
    )
    named = lambda kind: F.transform(F.col(kind), lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    base = F.concat(*(named(k) for k in kinds))
    seeds = F.concat(*(_seeds(F.col(k)) for k in kinds))
    apart = lambda name, spans: F.filter(name, lambda t: ~_overlaps(F.col(spans), t))
    rows = found.select("row", base.alias("base"), seeds.alias("seeds"), "groups", "single")
    rows = rows.select("row", "base", "seeds", apart("groups", "base").alias("groups"), apart("single", "base").alias("single"))
    others = F.concat("groups", apart("single", "groups"))
    marked = lambda instances, seed: F.transform(instances, lambda t: t.withField("seed", F.lit(seed)))
    rows = rows.select("row", "base", F.concat(marked(F.col("seeds"), True), marked(others, False)).alias("tokens"))
    rows = freeze(rows.withColumn("at", F.monotonically_increasing_id()), "personal")
    tokens = rows.select("at", F.explode("tokens").alias("t")).select("at", "t.*").withColumn("context", F.explode("contexts"))
    edges = freeze(tokens.groupBy("context", "token").agg(F.max("seed").alias("seed")), "contexts")
    more = (
        tokens.where("NOT seed").join(confident_patterns(edges), "context", "left_semi")
        .groupBy("at").agg(F.sort_array(F.collect_set(F.struct(F.lit("found").alias("kind"), "start", "end"))).alias("more"))
    )
    nothing = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return rows.join(more, "at", "left").select("row", "base", F.concat("base", F.coalesce("more", nothing)).alias("spans"))


def mask(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; of spans that overlap, the first one's kind covers all."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def step(acc, s):
        piece = F.when(
            s["start"] >= acc["at"],
            F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]")),
        ).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), piece.alias("out"))

    done = F.aggregate(ordered, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) == 0, text).otherwise(done)


def listed(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
