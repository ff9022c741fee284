"""Personal data by bootstrapped contextual extraction; DataFrame operations only.

Fixed patterns find e-mail addresses, IP addresses, payment cards and phone
numbers; their spans are the base.  Seen as seeds, the base spans induce
lexical patterns: the two words that stand before them, or the start of the
text.  Over all documents each identifier-like token and the words before it are an edge of a graph of
patterns and instances.  A pattern's confidence in a kind is the mean
reliability of the tokens after it that are seeds of the kind or look like it.
Seeds are certain (those of another kind certainly none), any other token is as
reliable as its other patterns make it: a pattern is no evidence for itself.  A
few rounds of joins and sums settle both.  Patterns of high confidence and
support then mark the identifiers that no fixed pattern finds; a pattern may
mark several kinds, each token as the surest of those that it looks like.

A pattern needs ``LEAST_SEEDS`` different seeds of its kind, at every size of
the table, and patterns and instances meet in joins that deal out the hot ones;
none is held in the driver.  The base and the tokens are found within the row
and written once under a row number; the edges, summed by pattern and instance
before the shuffle, and the identifier-like tokens cross the network.

Defined cases: null texts are empty; rows are read one by one, so repeated
rows and repeated or null doc_ids give a row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekwise.llm.common import Scratch, salted_lookup

KINDS = ("email", "ip", "card", "phone")
# The contract's patterns.  A run that cannot match is tried from its start
# only (or from the end of the last match), and what no later part needs back
# is kept, so long runs cost linear time and no stack.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Tokens that may be identifiers.  What stands before their first digit or sign
# is read from the text before it.  A run of 7 to 19 digits in groups, blanks
# and other separators of the base kinds between them, is one token (not dotted
# groups, nor a first group that is long enough by itself); so is what
# surrounds a written-out at sign.  Else a token has no blank.
_GROUP = r"(?![0-9]++\.[0-9]++\.[0-9])[0-9](?:[().-]{0,3}+[0-9])*+"
_RUN = (r"(?<![^\s(+\[{<\"':;,=|*#-])(?<!(?<![A-Za-z0-9])[0-9]{1,6}[\x20().-]{1,6})(?!(?:[0-9][().-]{0,3}+){7})"
        r"(?=(?:[\x20().-]{0,6}+[0-9]){7})(?!(?:[\x20().-]{0,6}+[0-9]){20})"
        + _GROUP + r"(?:[().-]{0,2}+\x20[\x20().-]{0,3}+" + _GROUP + r"(?![A-Za-z0-9_@%+]))++")
_AT = r"(?i:\[at\]|\(at\))"
TOKEN = _RUN + r"|[0-9@]\S*+|" + _AT + r"\x20?+[A-Za-z0-9]\S*+"
START = "\n"             # the word that stands before a text
# Characters that are read before a token, until two whole words are among them; then all.
READS = (120, 1 << 12, 1 << 17, 1 << 30)
# What an identifier of a kind must look like to be marked by its context.
# Groups give nothing back, so long tokens take no stack.
LOOKS = {
    "email": r"^[^\s@]+\x20?(?:@|" + _AT + r")\x20?[^\s@]+$",
    "ip": r"^[0-9A-Fa-f]*+(?:[.:][0-9A-Fa-f]*+){3,}+$",
    "card": r"^(?:[^0-9]*+[0-9]){12,}+[^0-9]*+$",
    "phone": r"^[(+]{0,2}(?:[^0-9A-Za-z]{0,6}+[0-9]){7,}+[^0-9A-Za-z]*+$",
}
ROUNDS = 3
CONFIDENCE = 0.8
LEAST_SEEDS = 5          # different seeds of a kind that a pattern has met

APPENDED = 256           # matches that one array is built of
SPAN = "array<struct<start:int,end:int,found:string>>"


def _with_occurrences(df: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """Adds, by name, the start, end and text of all matches in ``body``.

    They follow from the lengths of the matches and of what stands between.
    Each regular expression runs once for the matches and, where there are
    any, once for the gaps.
    """
    kept = df.columns
    found = {k: F.regexp_extract_all("body", F.lit(p), F.lit(0)) for k, p in patterns.items()}
    df = df.select(*kept, *[c.alias(f"{k}_found") for k, c in found.items()])
    df = df.select("*", *[F.when(F.size(f"{k}_found") > 0, F.split("body", p, -1)).alias(f"{k}_gaps")
                          for k, p in patterns.items()])

    def lengths(k):
        n = F.size(f"{k}_found")
        both = F.zip_with(f"{k}_found", F.slice(f"{k}_gaps", 1, n), lambda m, g: F.struct(
            F.length(g).alias("gap"), F.length(m).alias("n"), m.alias("m")))
        return F.when(n > 0, both)

    df = df.select(*kept, *[lengths(k).alias(f"{k}_both") for k in patterns])

    def add(acc, x):
        start = acc["at"] + x["gap"]
        return F.struct((start + x["n"]).alias("at"), F.array_append(acc["out"], F.struct(
            start.alias("start"), (start + x["n"]).alias("end"), x["m"].alias("found"))).alias("out"))

    def spans(k):
        # by blocks, as each append copies what the array has
        both = F.col(f"{k}_both")

        def block(b):
            before = F.aggregate(F.slice(both, 1, b * APPENDED), F.lit(0), lambda at, x: at + x["gap"] + x["n"])
            start = F.struct(before.alias("at"), F.array().cast(SPAN).alias("out"))
            return F.aggregate(F.slice(both, b * APPENDED + 1, APPENDED), start, add, lambda acc: acc["out"])

        blocks = F.sequence(F.lit(0), F.floor((F.size(both) - 1) / APPENDED).cast("int"))
        return F.when(both.isNotNull(), F.flatten(F.transform(blocks, block))).otherwise(F.array().cast(SPAN))

    return df.select(*kept, *[spans(k).alias(k) for k in patterns])


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def weight(d, i):
        doubled = d.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return doubled - F.when(doubled > 9, 9).otherwise(0)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), weight), F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, found: Column) -> Column:
    if kind == "ip":
        def small(part):
            value = F.regexp_replace(part, "^0+(?=[0-9])", "")
            return (F.length(value) <= 3) & (F.substring(value, 1, 3).cast("int") <= 255)
        return F.forall(F.split(found, r"\."), small)
    if kind == "card":
        digits = _digits(found)
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(found)).between(8, 15)
    return F.lit(True)


def _validity(kind: str):
    return lambda s: _valid(kind, s["found"])


def _of_kind(kind: str):
    return lambda s: s["kind"] == kind


def _as_kind(kind: str):
    return lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                              s["found"].alias("found"))


def with_base(docs: DataFrame) -> DataFrame:
    """(doc_id, body, email, ip, card, phone): the text and its base spans."""
    out = _with_occurrences(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("body")), PATTERNS)
    return out.select("doc_id", "body", *[F.filter(k, _validity(k)).alias(k) for k in KINDS])


def with_tokens(base: DataFrame) -> DataFrame:
    """Adds ``tokens``: identifier-like tokens with the words before them and the kind they are a seed of.

    Sentence signs at a token's ends are not part of it.  Tokens inside a base
    span, but for the one that begins it and has its text, are left out.
    """
    raw = _with_occurrences(base, {"raw": TOKEN})

    def with_words(t):
        def read(n):
            reach = F.least(t["start"], F.lit(n))
            ahead = F.substring(F.col("body"), t["start"] - reach + 1, reach)
            head = F.when(t["found"].rlike(r"^[\[(]"), F.regexp_extract(ahead, r"(?<!\S)\S*+\x20?+\z", 0)).otherwise(
                F.regexp_extract(ahead, r"(?<!\S)\S*+\z", 0))
            split = F.transform(F.array(F.struct(ahead.alias("ahead"), head.alias("head"))), lambda x: F.struct(
                x["head"].alias("head"), F.array_remove(F.split(F.lower(F.substring(
                    x["ahead"], F.lit(1), F.length(x["ahead"]) - F.length(x["head"]))), r"\s+"), "").alias("words")))
            # the first word that is read may lack its beginning
            return F.get(F.filter(split, lambda x: (t["start"] <= n) | (F.size(x["words"]) >= 3)), F.lit(0))

        return F.struct(F.coalesce(*[read(n) for n in READS]).alias("before"), t["end"].alias("end"),
                        t["found"].alias("found"))

    def with_left(t):
        whole = F.concat(t["before"]["head"], t["found"])
        left = F.ltrim(whole, F.lit("([{<\"':;,.!?*#|=-"))
        # a bracket that closes after the first digits belongs to them
        opened = left.rlike(r"^[0-9]{1,5}\)[\x20.-]*[0-9]") & F.endswith(
            F.substring(whole, F.lit(1), F.length(whole) - F.length(left)), F.lit("("))
        return F.struct(F.when(opened, F.concat(F.lit("("), left)).otherwise(left).alias("left"),
                        t["before"]["words"].alias("words"), t["end"].alias("end"))

    def with_core(t):
        return F.struct((t["end"] - F.length(t["left"])).alias("start"), t["end"].alias("until"),
                        F.rtrim(t["left"], F.lit(")]}>\"':;,.!?*#|")).alias("core"), t["words"].alias("words"))

    def with_seed(t):
        seed, whole, inside = F.lit(None).cast("string"), t["core"], F.lit(False)
        for k in KINDS:
            begins = F.get(F.filter(k, lambda s: (s["start"] >= t["start"]) & (s["start"] < t["until"])), F.lit(0))
            within = F.exists(k, lambda s: (s["start"] < t["start"]) & (s["end"] > t["start"]))
            seed = F.when(F.size(k) > 0, F.when(begins.isNotNull(), k).otherwise(seed)).otherwise(seed)
            whole = F.when(F.size(k) > 0, F.coalesce(begins["found"], whole)).otherwise(whole)
            inside = inside | ((F.size(k) > 0) & within)
        words = F.slice(F.concat(F.array(F.lit(START), F.lit(START)), t["words"]), -2, 2)
        pattern = F.regexp_replace(F.array_join(words, " "), "[0-9]", "9")
        return F.struct(t["start"].alias("start"), (t["start"] + F.length(t["core"])).alias("end"),
                        whole.alias("found"), pattern.alias("pattern"), seed.alias("seed"), inside.alias("inside"))

    tokens = F.transform(F.transform(F.transform(F.transform("raw", with_words), with_left), with_core), with_seed)
    return raw.withColumn("tokens", F.filter(tokens, lambda t: ~t["inside"])).drop("raw")


def _looks(found: Column, kind: Column) -> Column:
    """Whether a token looks like an identifier of the kind."""
    out = F.lit(False)
    for k in KINDS:
        out = out | ((kind == k) & found.rlike(LOOKS[k]))
    return out


def confident_patterns(rows: DataFrame, scratch: Scratch, rounds: int = ROUNDS,
                       confidence: float = CONFIDENCE, least_seeds: int = LEAST_SEEDS) -> DataFrame:
    """(kind, pattern, confidence): the patterns that mark unseen identifiers."""
    # explode would put a filter on all that makes the tokens below it, once for each use
    token = rows.select(F.explode_outer("tokens").alias("t")).filter("t is not null")
    edges = scratch.save(token.groupBy(F.col("t.pattern").alias("pattern"), F.col("t.found").alias("instance"),
                                       F.col("t.seed").alias("seed")).agg(F.count("*").alias("n")), "edges")
    # an edge is there once, so a pattern's edges of a kind count its different seeds
    met = edges.groupBy("pattern").agg(F.count("*").alias("weight"),
                                       *[F.count(F.when(F.col("seed") == k, 1)).alias(k) for k in KINDS])
    kinds = F.array_compact(F.array(*[F.when(F.col(k) >= least_seeds, F.lit(k)) for k in KINDS]))
    met = scratch.save(met.select("pattern", "weight", kinds.alias("kinds")).filter(F.size("kinds") > 0), "patterns")
    near = scratch.save(salted_lookup(edges, met, ["pattern"], "weight", ["instance"])
                        .select("pattern", "instance", "seed", "n", F.explode("kinds").alias("kind"))
                        .filter((F.coalesce("seed", F.lit("")) == F.col("kind")) | _looks(F.col("instance"), F.col("kind"))),
                        "near")
    sure = F.when(F.col("seed") == F.col("kind"), 1.0).when(F.col("seed").isNotNull(), 0.0)
    rated = near.withColumn("r", F.coalesce(sure, F.lit(0.0)))
    conf = None
    for _ in range(rounds):
        if conf is not None:
            # independent patterns: an instance fails only if all others of its patterns do
            fails = F.log(1 - F.least("confidence", F.lit(0.999))).cast("decimal(20,9)")
            held = scratch.save(salted_lookup(near, conf, ["kind", "pattern"], "weight", ["instance"])
                                .withColumn("fails", fails).drop("confidence"), "held")
            all_fail = scratch.save(held.groupBy("instance", "kind").agg(
                F.sum("fails").alias("all_fail"), F.count("*").alias("weight")), "instances")
            others = 1 - F.exp((F.col("all_fail") - F.col("fails")).cast("double"))
            rated = salted_lookup(held, all_fail, ["instance", "kind"], "weight", ["pattern"]).withColumn(
                "r", F.coalesce(sure, others))
        total = F.sum((F.col("r") * F.col("n")).cast("decimal(28,9)")).cast("double")
        conf = scratch.save(rated.groupBy("kind", "pattern").agg(
            (total / (F.sum("n") + 1)).alias("confidence"), F.count("*").alias("weight")), "confidence")
    return conf.filter(F.col("confidence") >= confidence).drop("weight")


def find_spans(docs: DataFrame, rounds: int = ROUNDS, confidence: float = CONFIDENCE,
               least_seeds: int = LEAST_SEEDS) -> DataFrame:
    """(doc_id, base, marked): arrays of (kind, start, end, found) per row.

    ``base`` has the spans of the fixed patterns by kind and start, ``marked``
    those that context adds.
    """
    scratch = Scratch(docs.sparkSession, "pii")
    listed = F.concat(*[F.transform(k, _as_kind(k)) for k in KINDS])
    rows = scratch.save(with_tokens(with_base(docs)).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", listed.alias("base"), "tokens"), "rows")
    found = confident_patterns(rows, scratch, rounds, confidence, least_seeds)
    found = found.groupBy("pattern").agg(F.collect_list(F.struct("confidence", "kind")).alias("kinds"))   # four at most

    any_kind = F.lit(False)
    for k in KINDS:
        any_kind = any_kind | F.col("found").rlike(LOOKS[k])
    unseen = rows.select("row", F.explode_outer("tokens").alias("t")).filter("t is not null and t.seed is null")
    unseen = scratch.save(unseen.select("row", "t.start", "t.end", "t.found", "t.pattern").filter(any_kind), "unseen")
    marking = scratch.save(unseen.groupBy("pattern").agg(F.count("*").alias("weight")).join(found, "pattern"), "marking")
    # a token of several kinds is marked as the one its pattern is surest of
    each = salted_lookup(unseen, marking, ["pattern"], "weight", ["row", "start"]).select(
        "row", "start", "end", "found", F.explode("kinds").alias("k")).select("*", "k.kind", "k.confidence").filter(
        _looks(F.col("found"), F.col("kind")))
    each = each.groupBy("row", "start", "end", "found").agg(F.max(F.struct("confidence", "kind"))["kind"].alias("kind"))
    marked = each.groupBy("row").agg(
        F.collect_list(F.struct("kind", "start", "end", "found")).alias("marked"))
    empty = F.array().cast("array<struct<kind:string,start:int,end:int,found:string>>")
    return rows.drop("tokens").join(marked, "row", "left").select(
        "doc_id", "base", F.coalesce(F.array_sort("marked"), empty).alias("marked"))


def _written(spans: Column) -> Column:
    order = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    keyed = F.transform(spans, lambda s: F.struct(order[s["kind"]].alias("o"), s["start"], s["end"], s["kind"]))
    return F.array_join(F.transform(F.array_sort(keyed), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans, of every text."""
    found = find_spans(docs)
    counts = [F.size(F.filter("base", _of_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(_written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        _written(F.concat("base", "marked")).alias("spans"))
