"""Personal data by bootstrapped contextual extraction, with built-in functions only.

Seeds are the identifiers that fixed rules find: e-mail and IP addresses, payment cards, phone numbers. Each seed induces
lexical patterns from the words around it. Texts also hold candidates: spans that look like an identifier but that no rule
accepts. Patterns and the values they occur with form a graph, on which scores go to and fro:

- a pattern's score for a kind is the sum of what its values say for that kind, over the number of its values and one. A seed
  says 1 for its own kind; a candidate without support says nothing, so it counts against the pattern;
- what a candidate says to a pattern is its support by all its *other* patterns together: 1 less the product of 1 less their
  scores. So a pattern never confirms itself, and a value found in one context carries its kind into others.

Each round looks only at what patterns of some score touch, until the scores rest. Patterns of high score that enough
different known values support discover: each place of a candidate of fitting form in such a pattern is a new span. Spans of
the rules always stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import let, stored

KINDS = ("email", "ip", "card", "phone")
# A pattern discovers from so many different known values of the kind on, and from this score; so does a value count as known.
SUPPORT = 4
CONFIDENCE = 0.7
# Scores below this are not passed on. The rounds end when the sum of all scores grows by less than a hundredth, or after MOST.
_LEAST, _REST, MOST = 0.01, 0.01, 30
# A word of a pattern is represented by so many of its nearest characters.
_WORD = 48

# The rules' patterns, written so that a search takes time in proportion to the text: runs do not give back what they took,
# and a search does not begin inside a run that has failed as a whole.
_MAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
_IP_PARTS = rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$"
# Spans that look like an identifier: a word with @ inside, or digits with at most two separators between them.
_MAIL_LIKE = r"(?<![^\s<>\"'(),;:=\[\]@])[^\s<>\"'(),;:=\[\]@]++@[^\s<>\"'(),;:=\[\]@]++"
_IP_FORM = r"^[0-9]+([.:][0-9]+){3,7}$"
_NUMBER_LIKE = r"(?<![\p{L}0-9_])[+(]?[0-9](?:[\x20.()/:-]{0,2}[0-9])++(?![\p{L}_])"


def _running(sizes: Column) -> Column:
    """Running totals of an array of numbers, in blocks so that the work stays near linear."""
    n = 64

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda a, x: a + x)

    def in_blocks(blocks: Column) -> Column:
        before = let(F.transform(blocks, total), lambda sums: F.transform(sums, lambda _, i: total(F.slice(sums, F.lit(1), i))))
        each = F.zip_with(
            blocks, before, lambda block, base: F.transform(block, lambda _, j: base + total(F.slice(block, F.lit(1), j + 1)))
        )
        return F.flatten(each)

    cut = lambda all_sizes: F.transform(F.sequence(F.lit(0), F.size(all_sizes) - 1, F.lit(n)), lambda b: F.slice(all_sizes, b + 1, n))
    return let(sizes, lambda all_sizes: let(cut(all_sizes), in_blocks))


def _spans(text: Column, pattern: str, maybe: Column) -> Column:
    """All matches as (start, end, value, left, right): code points, and the text next to the match. ``maybe`` is a cheap test."""
    kind = "array<struct<start:int,end:int,value:string,left:string,right:string>>"

    def placed(parts: Column) -> Column:
        values, pieces = parts["values"], parts["pieces"]
        sides = F.zip_with(F.slice(pieces, F.lit(1), F.size(values)), F.slice(pieces, F.lit(2), F.size(values)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        rows = F.zip_with(values, sides, lambda v, s: F.struct(v.alias("v"), s["a"].alias("a"), s["b"].alias("b")))
        ends = _running(F.transform(rows, lambda r: F.length(r["v"]) + F.length(r["a"])))
        return F.zip_with(
            rows, ends,
            lambda r, e: F.struct(
                (e - F.length(r["v"])).alias("start"), e.alias("end"), r["v"].alias("value"),
                r["a"].alias("left"), r["b"].alias("right"),
            ),
        ).cast(kind)

    none = F.array().cast(kind)
    values = F.when(maybe, F.regexp_extract_all(text, F.lit(pattern), 0)).otherwise(F.array().cast("array<string>"))
    return let(
        values,
        lambda found: F.when(
            F.size(found) > 0, let(F.struct(found.alias("values"), F.split(text, pattern, -1).alias("pieces")), placed)
        ).otherwise(none),
    )


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit of a string of digits holds."""

    def total(backwards: Column) -> Column:
        at = lambda i: F.substring(backwards, i, F.lit(1)).cast("int")
        one = lambda i: F.when(i % 2 == 1, at(i)).when(at(i) > 4, at(i) * 2 - 9).otherwise(at(i) * 2)
        return F.aggregate(F.sequence(F.lit(1), F.length(backwards)), F.lit(0), lambda a, i: a + one(i))

    return let(F.reverse(digits), total) % 10 == 0


def _base(text: Column) -> dict[str, Column]:
    size = lambda s: F.length(_digits(s["value"]))
    cards = F.filter(_spans(text, _CARD, F.col("long_number")), lambda s: size(s).between(14, 19))
    return {
        "email": _spans(text, _MAIL, F.contains(text, F.lit("@"))),
        "ip": F.filter(_spans(text, _IP, F.rlike(text, F.lit(r"[0-9]\.[0-9]+\.[0-9]"))), lambda s: F.rlike(s["value"], F.lit(_IP_PARTS))),
        "card": F.filter(cards, lambda s: luhn(_digits(s["value"]))),
        "phone": F.filter(_spans(text, _PHONE, F.contains(text, F.lit("+"))), lambda s: size(s).between(10, 15)),
    }


def _contexts(span: Column) -> Column:
    """Lexical patterns of a span: two words before it, one before and one after it, and the word before it if that ends in a mark.

    Words are the nearest ones, whatever white space lies between; digits count alike.
    """
    plain = lambda c: F.lower(F.regexp_replace(c, "[0-9]", "0"))
    # From its end, the text before the span begins with the nearest word.
    nearest = lambda n: F.regexp_extract(F.reverse(span["left"]), r"^\s*+(\S++)?+\s*+(\S++)?+", n)
    word = lambda n: let(
        F.reverse(F.left(nearest(n), F.lit(_WORD))), lambda w: F.when(w == "", F.lit("^")).otherwise(plain(w))
    )
    after = let(
        F.left(F.regexp_extract(span["right"], r"^\s*+(\S++)", 1), F.lit(_WORD)), lambda w: F.when(w == "", F.lit("$")).otherwise(plain(w))
    )

    def patterns(words: Column) -> Column:
        one, two, next_ = words["one"], words["two"], words["next"]
        return F.array(
            F.concat(F.lit("2 "), two, F.lit(" "), one), F.concat(F.lit("b "), one, F.lit(" "), next_), F.when(F.rlike(one, F.lit(r"[:=#]$")), F.concat(F.lit("1 "), one))
        )

    found = let(F.struct(word(1).alias("one"), word(2).alias("two"), after.alias("next")), patterns)
    return F.filter(found, lambda p: p.isNotNull())


def _forms(value: Column) -> Column:
    """Kinds that a candidate's form allows."""
    n = F.length(_digits(value))
    mail = F.contains(value, F.lit("@"))
    kinds = F.array(
        F.when(mail, "email"), F.when(~mail & F.rlike(value, F.lit(_IP_FORM)), "ip"),
        F.when(~mail & n.between(12, 19), "card"), F.when(~mail & n.between(7, 15), "phone"),
    )
    return F.filter(kinds, lambda k: k.isNotNull())


def extract(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(id, text_hash, base, added) of every given row: arrays of (kind, start, end, value), ``base`` from the rules.

    NULL counts as empty and has no spans. Repeated rows get the same spans, and count once in the graph. Spans of different
    kinds may overlap; an added span never overlaps one of the rules. An empty table gives an empty result.
    """
    found = identifiers(docs, text, id_column)
    added = discover(found)
    spans = F.transform("base", lambda s: F.struct(s["kind"], s["start"], s["end"], s["value"]))
    joined = found.select("id", "text_hash", spans.alias("base")).join(
        added.withColumnRenamed("id", "added_id").withColumnRenamed("text_hash", "added_hash"),
        F.col("id").eqNullSafe(F.col("added_id")) & (F.col("text_hash") == F.col("added_hash")), "left",
    )
    kind = "array<struct<kind:string,start:int,end:int,value:string>>"
    return joined.select("id", "text_hash", F.col("base").cast(kind).alias("base"), F.coalesce("added", F.array().cast(kind)).alias("added"))


def identifiers(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(id, text_hash, base, like) of every row: the rules' spans and the candidates, with their patterns; stored."""
    given = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # Two digits in a row or with one separator, 14 times: what a card needs.
    given = given.withColumn("long_number", F.rlike("text", F.lit(r"[0-9](?:[\x20-]?[0-9]){13}")))
    named = lambda kind, spans: F.transform(
        spans, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), _contexts(s).alias("patterns"))
    )
    base = F.concat(*[named(kind, spans) for kind, spans in _base(F.col("text")).items()])
    first = given.select("id", "text", F.xxhash64("text").alias("text_hash"), base.alias("base"))
    numbers = F.filter(_spans(F.col("text"), _NUMBER_LIKE, F.rlike("text", F.lit(r"[0-9][^\p{L}]{0,2}[0-9]"))), lambda s: (F.length(_digits(s["value"])) >= 7) | F.rlike(s["value"], F.lit(_IP_FORM)))
    mails = _spans(F.col("text"), _MAIL_LIKE, F.contains("text", F.lit("@")))
    free = lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    like = F.transform(
        F.filter(F.concat(numbers, mails), free),
        lambda s: F.struct(_forms(s["value"]).alias("kinds"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), _contexts(s).alias("patterns")),
    )
    return stored(first.select("id", "text_hash", "base", F.filter(like, lambda s: F.size(s["kinds"]) > 0).alias("like")), "identifiers")


def discover(found: DataFrame) -> DataFrame:
    """(id, text_hash, added) of rows with new spans."""
    seeds = found.select(F.explode("base").alias("s")).select("s.value", "s.kind", "s.patterns")
    likes = found.select("id", "text_hash", F.explode("like").alias("s")).select("id", "text_hash", "s.*")
    known = seeds.select(F.explode("patterns").alias("pattern"), "value", "kind", F.lit(True).alias("seed"))
    unknown = likes.select(F.explode("patterns").alias("pattern"), "value", "kinds").select(
        "pattern", "value", F.explode("kinds").alias("kind"), F.lit(False).alias("seed")
    )
    # One edge for a pattern, a value and a kind that the value can be of; a seed is of its own kind only.
    edges = stored(known.unionByName(unknown).groupBy("pattern", "value", "kind").agg(F.max("seed").alias("seed")), "graph")
    sizes = edges.groupBy("pattern").agg(F.countDistinct("value").alias("values"))
    certain = edges.where("seed").groupBy("pattern", "kind").agg(F.count("*").alias("seeds"))
    open_edges = edges.where("NOT seed").select("pattern", "value", "kind")
    share = F.col("mass") / (F.col("values") + 1)
    scores = stored(
        certain.join(sizes, "pattern").withColumn("mass", F.col("seeds").cast("double"))
        .select("pattern", "kind", "seeds", F.col("seeds").alias("support"), share.alias("score")), "scores",
    )
    total, rounds = scores.agg(F.sum("score")).first()[0] or 0.0, 0
    while total and rounds < MOST:
        telling = scores.where(F.col("score") >= _LEAST).select("pattern", "kind", F.log1p(-F.col("score")).alias("doubt"))
        doubts = open_edges.join(telling, ["pattern", "kind"]).groupBy("value", "kind").agg(F.sum("doubt").alias("doubts"))
        # To a pattern its values say what all their other patterns leave without doubt.
        said = open_edges.join(doubts, ["value", "kind"]).join(telling, ["pattern", "kind"], "left")
        said = said.select("pattern", "kind", (1 - F.exp(F.col("doubts") - F.coalesce("doubt", F.lit(0.0)))).alias("said"))
        sums = said.groupBy("pattern", "kind").agg(F.sum("said").alias("heard"), F.count_if(F.col("said") >= CONFIDENCE).alias("strong"))
        both = certain.join(sums, ["pattern", "kind"], "full").join(sizes, "pattern")
        both = both.withColumn("mass", F.coalesce("seeds", F.lit(0)) + F.coalesce("heard", F.lit(0.0)))
        support = F.coalesce("seeds", F.lit(0)) + F.coalesce("strong", F.lit(0))
        scores = stored(both.select("pattern", "kind", "seeds", support.alias("support"), share.alias("score")), "scores")
        before, total = total, scores.agg(F.sum("score")).first()[0]
        rounds += 1
        if total - before < _REST * before:
            break
    sure = scores.where((F.col("score") >= CONFIDENCE) & (F.col("support") >= SUPPORT)).select("pattern", "kind", "score")
    chosen = likes.select("id", "text_hash", "start", "end", "value", "kinds", F.explode("patterns").alias("pattern")).join(sure, "pattern")
    chosen = chosen.where(F.array_contains("kinds", F.col("kind")))
    best = chosen.groupBy("id", "text_hash", "start", "end", "value").agg(F.max(F.struct("score", "kind")).alias("b"))
    return best.groupBy("id", "text_hash").agg(
        F.collect_list(F.struct(F.col("b.kind").alias("kind"), "start", "end", "value")).alias("added")
    )


def _listing(spans: Column) -> Column:
    """kind:start:end by start, then kind in the order of KINDS."""
    rank = lambda s: F.array_position(F.array(*[F.lit(k) for k in KINDS]), s["kind"])
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("a"), rank(s).alias("b"), s["end"].alias("c"), s["kind"].alias("d"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["d"], s["a"].cast("string"), s["c"].cast("string"))), ",")


def digest_columns(extracted: DataFrame) -> DataFrame:
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return extracted.select(
        F.col("id").alias("doc_id"), *map(count, KINDS), F.sha2(_listing(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _listing(F.concat("base", "added")).alias("spans"),
    )
