"""Personal data by weak supervision, in DataFrame functions only.

1. Patterns find candidates of each kind with the text before and after.  ``split`` and ``regexp_extract_all`` over the same
   pattern give gaps and matches; running sums of their lengths are the positions, in code points.
2. Labelers vote on each candidate (1, 0 or no vote): the strict format, a gazetteer, the words before it, and its borders.
3. Expectation-maximisation over the counts of vote patterns estimates each labeler's reliability for each kind, and with it
   the probability that a pattern of votes means personal data.  There are at most 3^4 patterns of a kind, at any input size.
4. A naive Bayes classifier over features of the span, trained on these probabilities, decides on candidates.

Base spans (those whose format is valid) always stay.  The classifier adds candidates with probability ``ADD`` or more that overlap
no base span: obfuscated addresses, local phone numbers, identity numbers, card numbers with a wrong check digit.

The patterns are written so that the regex engine does no more than linear work: possessive quantifiers, and starts only at
the start of a run (or right after the last match).  They match exactly what the plain forms in ``tests/llm`` match.

Null and empty texts have no spans.  Very long texts, and texts of very many spans, take time in proportion.  Repeated rows and rows with null ids are each reported.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from yearring.llm.parts import written

ADD = 0.9
EM_ROUNDS = 40
BEFORE, AFTER = 40, 8
#: Characters of a piece that a text is cut into for redaction.
CHUNK = 4096

# Kinds in their order, and the patterns of the four base kinds.
KINDS = ("email", "ip", "card", "phone", "id")
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "email_hidden": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++ ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]++(?: ?(?:\(dot\)|\[dot\]|\.) ?[A-Za-z0-9-]++)++",
    "phone_local": r"(?<![0-9+().-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "id_number": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: Texts without these can't hold a match.
NEEDS = {
    "email": F.contains,
    "ip": r"[0-9]\.[0-9]",
    "card": r"[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9]",
    "phone": r"\+[0-9]",
    "email_hidden": r"[\[(]at[\])]",
    "phone_local": r"[0-9]{3}[\x20.-][0-9]{4}",
    "id_number": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
}
KIND_OF = {"email_hidden": "email", "phone_local": "phone", "id_number": "id"}
DOMAINS = ("com", "org", "net", "edu", "gov", "io", "info", "biz", "de", "fr", "es", "uk", "eu", "us", "ch", "at", "it", "nl")
ASKING = {
    "email": r"(?i)(mail|contact|write|address|from|to|cc|reply)\W{0,4}$",
    "ip": r"(?i)(\bip|host|server|address|client|login)\W{0,4}$",
    "card": r"(?i)(card|visa|master|amex|credit|debit|payment|pay)\W{0,6}(no|number|nr)?\W{0,4}$",
    "phone": r"(?i)(phone|tel|call|mobile|cell|fax|whatsapp|dial)\W{0,4}(no|number|nr)?\W{0,4}$",
    "id": r"(?i)(ssn|social|security|identity|passport|\bid)\W{0,4}(no|number|nr)?\W{0,4}$",
}
DENYING = r"(?i)(order|invoice|isbn|version|\bv|ref|part|item|page|chapter|figure|table|total|sum|art)\W{0,4}(no|number|nr)?\W{0,4}$"
LABELERS = 4


def _found(text: Column, name: str) -> Column:
    """Matches of a pattern with the gap before each: ``kind, source, k, gap, match, before, after``."""
    pattern = F.lit(PATTERNS[name])
    need = NEEDS[name]
    possible = F.contains(text, F.lit("@")) if need is F.contains else text.rlike(need)
    both = F.array(F.struct(F.regexp_extract_all(text, pattern, F.lit(0)).alias("m"), F.split(text, PATTERNS[name], -1).alias("p")))
    spans = F.transform(
        both,
        lambda b: F.transform(
            b["m"],
            lambda m, i: F.struct(
                F.lit(KIND_OF.get(name, name)).alias("kind"),
                F.lit(name).alias("source"),
                i.alias("k"),
                F.length(b["p"][i]).alias("gap"),
                m.alias("match"),
                F.right(b["p"][i], F.lit(BEFORE)).alias("before"),
                F.left(b["p"][i + 1], F.lit(AFTER)).alias("after"),
            ),
        ),
    )[0]
    return F.when(possible, spans)


def _luhn(match: Column) -> Column:
    digits = F.reverse(F.regexp_replace(match, "[^0-9]", ""))

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, i, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(i % 2 == 1, digit).otherwise(twice - F.when(twice > 9, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(source: Column, match: Column) -> Column:
    digits = F.length(F.regexp_replace(match, "[^0-9]", ""))
    part = lambda x: F.regexp_replace(x, "^0+", "")
    small = F.forall(F.split(match, r"\."), lambda x: (F.length(part(x)) < 3) | ((F.length(part(x)) == 3) & (part(x) <= "255")))
    return (
        F.when(source == "email", True)
        .when(source == "ip", small)
        .when(source == "card", F.when(digits.between(14, 19), _luhn(match)).otherwise(False))
        .when(source == "phone", digits.between(10, 15))
        .otherwise(False)
    )


def candidates(df: DataFrame, text: Column, *keep: Column) -> tuple[DataFrame, DataFrame]:
    """The rows (``row`` and what ``keep`` names) and the candidates of all of them, both written."""
    found = F.flatten(F.filter(F.array(*[_found(text, name) for name in PATTERNS]), lambda x: x.isNotNull()))
    rows = written(df.select(F.monotonically_increasing_id().alias("row"), *keep, found.alias("found")), "pii-rows")
    each = rows.select("row", F.explode("found").alias("f")).select("row", "f.*").withColumn("length", F.length("match"))
    before = Window.partitionBy("row", "source").orderBy("k")
    end = F.sum(F.col("gap") + F.col("length")).over(before.rowsBetween(Window.unboundedPreceding, 0)).cast("long")
    out = each.withColumn("end", end).withColumn("start", F.col("end") - F.col("length")).withColumn("base", _valid(F.col("source"), F.col("match")))
    return rows.drop("found"), written(out.drop("k", "gap"), "pii-candidates")


def _votes() -> Column:
    """One vote of each labeler: 1, 0 or null."""
    kind, source, match, before, after = (F.col(c) for c in ("kind", "source", "match", "before", "after"))
    digits = F.length(F.regexp_replace(match, "[^0-9]", ""))
    form = F.when(F.col("base") | source.isin("email_hidden", "phone_local"), 1).when(source == "id_number", F.when(match.rlike("^(000|666|9)|-00-|-0000$"), 0).otherwise(1)).otherwise(0)
    top = F.lower(F.regexp_extract(match, "([A-Za-z]+)$", 1))
    gazetteer = (
        F.when(kind == "email", F.when(top.isin(*DOMAINS), 1).otherwise(0))
        .when(source == "ip", F.when(match.rlike(r"^(0|127|255)\."), 0).otherwise(1))
        .when(kind == "card", F.when(match.rlike("^(3[47]|4|5[1-5]|2[2-7]|6)") & digits.between(14, 19), 1))
        .when(source == "phone", F.when(match.rlike(r"^\+(1|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])"), 1).otherwise(0))
    )
    asked = F.lit(False)
    for name, words in ASKING.items():
        asked = F.when(kind == name, before.rlike(words)).otherwise(asked)
    context = F.when(asked, 1).when(before.rlike(DENYING), 0)
    border = F.when(before.rlike(r"[\p{L}\p{N}_=/#-]$") | after.rlike(r"^[\p{L}\p{N}_=/]"), 0).otherwise(1)
    return F.array(form, gazetteer, context, border)


def _reliabilities(patterns: DataFrame) -> DataFrame:
    """Per kind: ``prior``, and ``hit`` and ``slip``, each labeler's rate of 1 on true and on false candidates.

    One aggregate over the rounds of expectation-maximisation, in SQL functions; its input has at most 3^4 entries.
    """
    odds = """aggregate(sequence(0, {n}), CAST(ln(s.prior / (1 - s.prior)) AS DOUBLE), (t, l) -> t + CASE p.votes[l]
                  WHEN 1 THEN ln(s.hit[l] / s.slip[l]) WHEN 0 THEN ln((1 - s.hit[l]) / (1 - s.slip[l])) ELSE 0D END)"""
    share = f"transform(seen, p -> CAST(1 / (1 + exp(-{odds})) AS DOUBLE))"
    total = "aggregate(sequence(0, size(seen) - 1), 0D, (t, k) -> t + {weight} * seen[k].n * {when})"
    mean = "transform(sequence(0, {n}), l -> CAST((1D + {yes}) / (2D + {all}) AS DOUBLE))"
    rate = lambda w: mean.replace("{yes}", total.format(weight=w, when="CAST(seen[k].votes[l] <=> 1 AS INT)")).replace(
        "{all}", total.format(weight=w, when="CAST(seen[k].votes[l] IS NOT NULL AS INT)")
    )
    prior = f"CAST((1D + {total.format(weight='q[k]', when='1')}) / (2D + {total.format(weight='1D', when='1')}) AS DOUBLE)"
    step = f"transform(array({share}), q -> struct({prior} AS prior, {rate('q[k]')} AS hit, {rate('(1D - q[k])')} AS slip))[0]"
    start = "struct(0.5D AS prior, array_repeat(0.8D, {m}) AS hit, array_repeat(0.3D, {m}) AS slip)"
    em = f"aggregate(sequence(1, {EM_ROUNDS}), {start}, (s, i) -> {step})".replace("{n}", str(LABELERS - 1)).replace("{m}", str(LABELERS))
    seen = patterns.groupBy("kind").agg(F.array_sort(F.collect_list(F.struct("votes", F.col("count").alias("n")))).alias("seen"))
    return seen.withColumn("s", F.expr(em)).select("kind", F.explode("seen").alias("p"), "s").select(
        "kind", "p.votes", F.expr(f"1 / (1 + exp(-{odds.replace('{n}', str(LABELERS - 1))}))").alias("truth")
    )


def _features() -> Column:
    """Discrete features of a span, each from a fixed set of values."""
    match, before, after = F.col("match"), F.col("before"), F.col("after")
    side = lambda c: F.when(c == "", "none").when(c.rlike(r"\p{L}"), "letter").when(c.rlike("[0-9]"), "digit").when(c.rlike(r"\s"), "space").otherwise("other")
    group = lambda n: F.least(n, F.lit(24)).cast("string")
    digits = F.length(F.regexp_replace(match, "[^0-9]", ""))
    values = [
        F.concat(F.lit("source="), "source"),
        F.concat(F.lit("length="), group(F.length(match))),
        F.concat(F.lit("digits="), group(digits)),
        F.concat(F.lit("left="), side(F.right(before, F.lit(1)))),
        F.concat(F.lit("right="), side(F.left(after, F.lit(1)))),
        F.concat(F.lit("valid="), F.col("base").cast("string")),
        F.concat(F.lit("denied="), before.rlike(DENYING).cast("string")),
        F.concat(F.lit("breaks="), group(F.length(F.regexp_replace(match, "[^ .()-]", "")))),
    ]
    return F.array(*values)


def classified(spans: DataFrame) -> DataFrame:
    """``spans`` with ``probability``: naive Bayes trained on what the labelers say together."""
    voted = spans.withColumn("votes", _votes()).withColumn("features", _features())
    truth = _reliabilities(voted.groupBy("kind", "votes").count())
    # One row for each kind and vote pattern, at most 5 x 81.
    known = voted.join(F.broadcast(truth), (voted["kind"] == truth["kind"]) & voted["votes"].eqNullSafe(truth["votes"])).drop(truth["kind"]).drop(truth["votes"])
    sums = known.select("kind", F.explode("features").alias("feature"), "truth").groupBy("kind", "feature").agg(F.sum("truth").alias("yes"), F.sum(1 - F.col("truth")).alias("no"))
    totals = known.groupBy("kind").agg(F.sum("truth").alias("all_yes"), F.sum(1 - F.col("truth")).alias("all_no"))
    weight = F.log((F.col("yes") + 0.5) / (F.col("all_yes") + 1)) - F.log((F.col("no") + 0.5) / (F.col("all_no") + 1))
    prior = F.log((F.col("all_yes") + 0.5) / (F.col("all_no") + 0.5))
    # One row for each kind; the features take under 100 values.
    model = sums.join(totals, "kind").groupBy("kind").agg(F.map_from_entries(F.collect_list(F.struct("feature", weight))).alias("weights"), F.first(prior).alias("prior"))
    odds = F.aggregate("features", F.col("prior"), lambda t, x: t + F.coalesce(F.element_at("weights", x), F.lit(0.0)))
    return voted.join(F.broadcast(model), "kind").withColumn("probability", 1 / (1 + F.exp(-odds))).drop("weights", "prior", "features")


def chosen(spans: DataFrame, add: float = ADD) -> DataFrame:
    """Base spans, and those that the classifier adds where no base span is and no earlier addition."""
    scored = classified(spans).filter(F.col("base") | (F.col("probability") >= add))
    # Both frames end before the row, in one order and in its reverse, so that each is a running value.
    keys = ("start", "end", "source", "kind")
    before = lambda *order: Window.partitionBy("row").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier, later = before(*keys), before(*[F.desc(k) for k in keys])
    base = F.col("base")
    clear = (
        (F.coalesce(F.max(F.when(base, F.col("end"))).over(earlier), F.lit(0)) <= F.col("start"))
        & (F.coalesce(F.min(F.when(base, F.col("start"))).over(later), F.col("end")) >= F.col("end"))
        & (F.coalesce(F.max(F.when(~base, F.col("end"))).over(earlier), F.lit(0)) <= F.col("start"))
    )
    return scored.withColumn("clear", clear).filter(base | F.col("clear"))


def pii_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", add: float = ADD) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` per row; the counts are of base spans."""
    rows, spans = candidates(df, F.coalesce(F.col(text_col), F.lit("")), F.col(id_col).cast("long").alias("doc_id"))
    number = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    named = F.struct("start", number.alias("number"), F.concat_ws(":", "kind", "start", "end").alias("name"))
    joined = lambda c: F.array_join(F.transform(F.array_sort(c), lambda s: s["name"]), ",")
    counts = [F.count_if(F.col("base") & (F.col("kind") == k)).alias(f"n_{k}") for k in KINDS[:4]]
    by_row = chosen(spans, add).groupBy("row").agg(
        *counts,
        F.sha2(joined(F.collect_list(F.when(F.col("base"), named))), 256).alias("base_sha256"),
        joined(F.collect_list(named)).alias("spans"),
    )
    none = F.sha2(F.lit(""), 256)
    return rows.join(by_row, "row", "left").select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in KINDS[:4]], F.coalesce("base_sha256", none).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans")
    )


def redact(df: DataFrame, text_col: str = "text", add: float = ADD) -> DataFrame:
    """``df`` with every span replaced by its kind in angle brackets; overlapping spans are replaced as one."""
    data = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("data")
    rows, spans = candidates(df, F.coalesce(F.col(text_col), F.lit("")), data)
    order = Window.partitionBy("row").orderBy("start", "end", "source")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum((F.coalesce(reach, F.lit(-1)) < F.col("start")).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    merged = chosen(spans, add).withColumn("island", island).groupBy("row", "island").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("kind", "start").alias("kind")
    )
    marks = merged.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("marks"))
    text = F.col("data").getField(text_col)

    def between(chunks: Column, begin: Column, end: Column) -> Column:
        """Characters from begin up to end, from the chunks that they lie in: a substring of the text would count from its start."""
        one, two = F.floor(begin / CHUNK), F.floor(end / CHUNK)
        near = F.array_join(F.slice(chunks, (one + 1).cast("int"), (two - one + 1).cast("int")), "")
        return F.substring(near, (begin - one * CHUNK + 1).cast("int"), (end - begin).cast("int"))

    def cover(chunks: Column) -> Column:
        begin = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get("marks", i - 1)["end"])
        pieces = F.transform("marks", lambda m, i: F.concat(between(chunks, begin(i), m["start"]), F.lit("<"), F.upper(m["kind"]), F.lit(">")))
        return F.concat(F.array_join(pieces, ""), between(chunks, F.element_at("marks", -1)["end"], F.length(text)))

    # The array of one element binds the chunks, so that they are cut once for a text and not for each mark.
    chunks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    masked = F.transform(F.array(chunks), cover)[0]
    new = F.when(F.col("marks").isNull(), text).otherwise(masked)
    out = rows.join(marks, "row", "left").withColumn("masked", new)
    return out.select(*[F.col("masked").alias(c) if c == text_col else F.col("data").getField(c).alias(c) for c in df.columns])
