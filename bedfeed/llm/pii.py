"""Personal data: exact forms, and identifiers that their context gives away, in DataFrame functions only.

The exact forms (email, ip, card, phone) are seeds. Every exact form is an instance, and so is what has the shape of
one: a token with a digit or an @, and groups of digits parted by spaces. The two words before the token it begins in
are its pattern. Patterns and instances form a graph: a pattern is trusted as far as its instances are, an instance that
is no seed as far as its patterns are; a few rounds spread the trust of the seeds. Tokens that are no seeds but
follow a pattern of high trust and enough seeds are found as well.

Positions come from splitting a text at the matches of an expression: the pieces and the matches, added up in
order. Expressions never step back over what they have read, so long runs of any letters take linear time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bedfeed.llm.common import let, stored, words_of
from bedfeed.session import compute_once

# The kinds in the order in which spans of one start are listed; the last one is found by context.
KINDS = ("email", "ip", "card", "phone", "context")
_MARK, _GROUPS, _TOKEN = -1, 8, 9

# The exact forms. \G and the look behind only keep the search from starting inside a run.
FORMS = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
# Words that an exact form can begin in: all others have neither a digit nor an @.
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
# Two or more groups of digits as cards and phones have them, and how many digits these have.
_GROUP = r"[0-9]++(?:[().-]++[0-9]++)*+\)?+"
GROUPS = rf"(?<![^\x20\x09-\x0D])[(+]*+{_GROUP}(?:\x20\(?{_GROUP})++"
GROUPS_DIGITS = (9, 19)

# A token is trimmed of these and must then be this long.
OPENING, CLOSING = "\"'([<{", "\"')]>}.,;:!?"
MIN_TOKEN = 6

ROUNDS = 3
MIN_SEEDS = 4
MIN_TRUST = 0.7


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: let(
        d.cast("int"), lambda x: F.when(i % 2 == 1, F.when(x > 4, 2 * x - 9).otherwise(2 * x)).otherwise(x)
    ))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: int, found: Column) -> Column:
    if kind == 1:
        return F.forall(F.split(found, r"\."), lambda part: let(
            F.ltrim(part, F.lit("0")), lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255"))
        ))
    if kind == 2:
        return let(_digits(found), lambda d: F.when(F.length(d).between(12, 19), _luhn(d)).otherwise(False))
    if kind == 3:
        return F.length(_digits(found)).between(9, 15)
    if kind == _GROUPS:
        return F.length(_digits(found)).between(*GROUPS_DIGITS)
    return F.lit(True)


def _last_two(words: Column) -> Column:
    return F.reverse(F.slice(F.reverse(words), 1, 2))


_FOUND = "array<struct<kind:int,nth:int,gap:int,length:int,good:boolean,token:string,near:array<string>>>"


def _matches(text: Column, kind: int, form: str, when: Column) -> Column:
    """All matches of a form: how long the piece before each is, the match, and what else is needed of it."""

    def of(pieces: Column) -> Column:
        token = kind == _TOKEN
        return F.transform(F.regexp_extract_all(text, F.lit(form), F.lit(0)), lambda m, j: F.struct(
            F.lit(kind).alias("kind"), j.alias("nth"), F.char_length(F.get(pieces, j)).alias("gap"), F.char_length(m).alias("length"),
            (F.lit(True) if token else _valid(kind, m)).alias("good"), m.alias("token"),
            (_last_two(words_of(F.get(pieces, j))) if token else F.lit(None).cast("array<string>")).alias("near"),
        ))

    return F.when(when, let(F.split(text, form, -1), of).cast(_FOUND)).otherwise(F.array().cast(_FOUND))


def _entities(docs: DataFrame) -> DataFrame:
    """One row per exact form, token or groups of digits, and one of kind -1 per document, with their places."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), F.xxhash64(F.col("doc_id").cast("string"), text).alias("key"), text.alias("text"))
    digit = F.col("text").rlike("[0-9]")
    needed = [F.col("text").contains("@"), digit & F.col("text").contains("."), digit, digit & F.col("text").contains("+")]
    mark = F.array(F.struct(
        F.lit(_MARK).alias("kind"), F.lit(0).alias("nth"), F.lit(0).alias("gap"), F.lit(0).alias("length"), F.lit(True).alias("good"),
        F.lit(None).cast("string").alias("token"), F.lit(None).cast("array<string>").alias("near"),
    )).cast(_FOUND)
    every = [_matches(F.col("text"), kind, form, needed[kind]) for kind, form in enumerate(FORMS)]
    found = compute_once(rows, {"found": F.concat(mark, *every, _matches(F.col("text"), _GROUPS, GROUPS, digit), _matches(F.col("text"), _TOKEN, TOKEN, digit | needed[0]))})
    each = found.select("row", "doc_id", "key", F.explode("found").alias("f")).select("row", "doc_id", "key", "f.*").repartition("row")
    so_far = Window.partitionBy("row", "kind").orderBy("nth")
    each = each.withColumn("end", F.sum(F.col("gap") + F.col("length")).over(so_far)).withColumn("start", F.col("end") - F.col("length"))
    # The words before a token: those of the piece before it, the token before that, and so on; tokens are whole words.
    none = F.array().cast("array<string>")
    before = [F.array_compact(F.array(F.lag("token", 2).over(so_far))), F.coalesce(F.lag("near", 1).over(so_far), none), F.array_compact(F.array(F.lag("token", 1).over(so_far)))]
    pattern = let(_last_two(F.concat(*before, F.coalesce("near", none))), lambda w: F.when(F.size(w) == 2, F.lower(F.array_join(w, " "))))
    each = each.withColumn("pattern", F.when(F.col("kind") == _TOKEN, F.struct(pattern.alias("words"))))
    # All others have the pattern of the token they begin in.
    begun = Window.partitionBy("row").orderBy("start", F.desc("kind")).rowsBetween(Window.unboundedPreceding, 0)
    each = each.withColumn("pattern", F.last("pattern", ignorenulls=True).over(begun)["words"])
    is_token = F.col("kind") == _TOKEN
    core = F.when(is_token, F.rtrim(F.ltrim(F.col("token"), F.lit(OPENING)), F.lit(CLOSING))).otherwise(F.col("token"))
    lead = F.when(is_token, F.length("token") - F.length(F.ltrim(F.col("token"), F.lit(OPENING))))
    each = each.withColumn("core", F.lower(core)).withColumn("lead", F.coalesce(lead, F.lit(0)))
    each = each.withColumn("start", F.col("start") + F.col("lead")).withColumn("end", F.when(is_token, F.col("start") + F.length("core")).otherwise(F.col("end")))
    each = each.where("good and (kind <> 9 or length(core) >= %d)" % MIN_TOKEN)
    # An exact form is a seed, and so is a token if an exact form overlaps it: one that starts at or before it, or one inside.
    exact = F.col("kind").between(0, 3)
    first = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    last = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    each = each.withColumn("seed", F.coalesce(F.max(F.when(exact, F.col("end"))).over(first) > F.col("start"), F.lit(False)))
    each = each.withColumn("seed", F.col("seed") | F.coalesce(F.min(F.when(exact, F.col("start"))).over(last) < F.col("end"), F.lit(False)))
    each = each.withColumn("seed", F.col("seed") | exact).where("not (kind = %d and seed)" % _GROUPS)
    return each.select("row", "doc_id", "key", "kind", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "core", "seed", "pattern")


def pattern_scores(entities: DataFrame) -> DataFrame:
    """(pattern, trust, seeds) from the graph of patterns and instances.

    A pattern's trust is the sum of its instances' over their number plus one; an instance that is no seed gets the
    chance that not all its patterns are wrong.
    """
    edges = entities.where("kind >= 0 and pattern is not null").groupBy("pattern", F.col("core").alias("instance")).agg(F.max("seed").alias("seed"))
    edges = stored(edges)
    seeds = edges.groupBy("instance").agg(F.max(F.col("seed").cast("double")).alias("base"))
    trust = seeds.select("instance", F.col("base").alias("trust"))
    for turn in range(ROUNDS):
        scores = edges.join(trust, "instance").groupBy("pattern").agg(
            (F.sum("trust") / (F.count("*") + 1)).alias("score"), F.sum(F.col("seed").cast("int")).alias("seeds"),
        )
        scores = stored(scores)
        if turn < ROUNDS - 1:
            doubt = F.sum(F.log(1 - F.least("score", F.lit(0.99))))
            heard = edges.join(scores, "pattern").groupBy("instance").agg((1 - F.exp(doubt)).alias("heard"))
            trust = stored(seeds.join(heard, "instance").select("instance", F.greatest("base", "heard").alias("trust")))
    return scores.select("pattern", F.col("score").alias("trust"), "seeds")


def personal_spans(docs: DataFrame) -> DataFrame:
    """(row, doc_id, key, kind, start, end): every span of documents (doc_id, text, anything else), and a row of kind
    -1 for every document. Kinds are places in `KINDS`; positions count code points, the end is exclusive.

    Null and empty texts have no spans. Rows that repeat a doc_id or a whole row have a ``row`` of their own; ``key``
    stands for doc_id and text. A token with fewer than two words before it has no pattern.
    """
    found = stored(_entities(docs))
    good = pattern_scores(found).where((F.col("trust") >= MIN_TRUST) & (F.col("seeds") >= MIN_SEEDS)).select("pattern", F.lit(True).alias("good"))
    tokens = found.where("kind >= 8 and not seed").join(good, "pattern", "left_semi").withColumn("kind", F.lit(len(KINDS) - 1))
    columns = ["row", "doc_id", "key", "kind", "start", "end"]
    return found.where("kind < 8").select(*columns).unionByName(tokens.select(*columns))


def span_texts(spans: DataFrame) -> DataFrame:
    """One row per document: the number of spans of each exact kind, and the exact and all spans as kind:start:end."""
    exact = F.col("kind").between(0, 3)
    one = F.struct("start", "kind", "end")
    out = spans.groupBy("row", "doc_id").agg(
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{KINDS[k]}") for k in range(4)],
        F.array_sort(F.collect_list(F.when(exact, one))).alias("base"),
        F.array_sort(F.collect_list(F.when(F.col("kind") >= 0, one))).alias("every"),
    )
    names = F.array(*[F.lit(k) for k in KINDS])

    def text(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")

    return out.select("doc_id", *[f"n_{k}" for k in KINDS[:4]], text("base").alias("base"), text("every").alias("spans"))


def redacted(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets; overlapping spans are one, named after the
    first. A column n_chars follows the text.

    Null and empty texts stay as they are, as do other columns, whatever their names. Rows that repeat a doc_id are cut
    each at the places of its own text, whole repeated rows at the same places; an empty table gives an empty one.
    """
    # A row is known by its doc_id and a digest of its text, on which alone the spans depend.
    digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    found = personal_spans(docs.select(F.struct("doc_id", digest.alias("digest")).alias("doc_id"), "text"))
    spans = found.where("kind >= 0").select(F.col("doc_id").alias("key"), "kind", "start", "end").distinct()
    order = Window.partitionBy("key").orderBy("start", "kind", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("start") < F.col("before"), 0).otherwise(1)).over(order)
    islands = spans.withColumn("before", before).withColumn("island", island).groupBy("key", "island").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min(F.struct("start", "kind")).alias("one"),
    )
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    cuts = islands.groupBy(F.col("key.doc_id").alias("cut_id"), F.col("key.digest").alias("cut_digest")).agg(
        F.array_sort(F.collect_list(F.struct("start", "end", F.get(names, F.col("one.kind")).alias("name")))).alias("cuts")
    )
    cuts = stored(cuts)
    # Columns go by their places, so that none clashes with those of the cuts.
    places = {c: f"c_{i}" for i, c in enumerate(docs.columns)}
    named = docs.select(*[F.col(c).alias(n) for c, n in places.items()], digest.alias("digest"))
    same = F.col(places["doc_id"]).eqNullSafe(F.col("cut_id")) & (F.col("digest") == F.col("cut_digest"))
    # One plan at all sizes: cuts are broadcast only while there are few, and their arrays are far larger in memory.
    joined = named.join(cuts.hint("merge"), same, "left")
    text = F.col(places["text"])

    def cut(from_: Column, to: Column) -> Column:
        return F.substring(text, (from_ + 1).cast("int"), (to - from_).cast("int"))

    def rebuilt(c: Column) -> Column:
        parts = F.transform(c, lambda x, i: F.concat(cut(F.coalesce(F.get(c, i - 1)["end"], F.lit(0).cast("long")), x["start"]), x["name"]))
        tail = cut(F.get(c, F.size(c) - 1)["end"], F.char_length(text).cast("long"))
        return F.concat(F.array_join(parts, ""), tail)

    clean = F.when(F.col("cuts").isNull(), text).otherwise(let(F.col("cuts"), rebuilt))
    out = compute_once(joined.select(*places.values(), clean.alias("clean")), {"clean": F.col("clean")})
    chars = F.char_length("clean").cast(dict(docs.dtypes).get("n_chars", "long"))
    changed = {"text": F.col("clean"), "n_chars": chars}
    return out.select(*[changed.get(c, F.col(n)).alias(c) for c, n in places.items()])
