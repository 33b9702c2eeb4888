"""Information-theoretic sanitisation of personal data, in DataFrame functions only.

Patterns find the protected entities: email addresses, IP addresses, card and phone numbers. Words are counted
together with an entity over the whole corpus, twice: by the places within ``WINDOW`` of it, and by the documents
that show both, however far apart. With at least ``SUPPORT`` of either, a word reveals the entity by ``share`` = its
places near that entity (documents with it) / all its places (documents), and by ``bits`` = the pointwise mutual
information of the two. A word at or above ``SHARE`` and ``BITS`` in one of the counts is disclosing, and all its
occurrences in all texts are marked: from ``REMOVE`` on they are removed, below that generalised to a placeholder.

Positions come from the texts between matches, so no function looks a position up; all work is linear in the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import c
from .stored import stored

WINDOW = 60                 # code points before and after an entity that are counted as places near it
SUPPORT = 3
SHARE = 0.5
BITS = 6.0
REMOVE = 0.9
TERM = r"\p{L}{3,}"

# Patterns (fixed values), written so that long runs are scanned once: possessive repeats, and a start only where
# a run starts or the last match ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone", "term")
PLACEHOLDERS = {"email": "<EMAIL>", "ip": "<IP>", "card": "<CARD>", "phone": "<PHONE>"}
_PATTERNS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
_CHUNK = 256

_SPAN = "array<struct<start:int,end:int,value:string,before:string,after:string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Check sum of a digit string: every second digit from the right is doubled."""
    places = F.sequence(F.lit(1), F.length(digits))
    def part(i: Column) -> Column:
        digit = F.substring(digits, i, F.lit(1)).cast("int")
        doubled = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return F.when((F.length(digits) - i) % 2 == 1, doubled).otherwise(digit)
    return F.aggregate(F.transform(places, part), F.lit(0), lambda s, v: s + v) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        trimmed = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(trimmed, lambda p: (F.length(p) <= 3) & (p.cast("int") <= 255))
    count = F.length(_digits(value))
    if kind == "card":
        return F.when((count >= 12) & (count <= 19), _luhn(_digits(value))).otherwise(F.lit(False))
    if kind == "phone":
        return (count >= 9) & (count <= 15)
    return F.lit(True)


def _is_valid(kind: str):
    return lambda span: _valid(kind, span["value"])


def _terms(text: Column) -> Column:
    """Distinct lower-case words of a text outside email addresses; the other entities hold no letters."""
    free = F.when(text.contains("@"), F.regexp_replace(text, EMAIL, "@")).otherwise(text)
    return F.array_distinct(F.transform(F.filter(F.split(free, r"\P{L}+"), lambda w: F.length(w) >= 3), F.lower))


def spans_of(df: DataFrame, text: str, pattern: str, out: str, when: Column) -> DataFrame:
    """Add ``out``: all matches as (start, end, value, before, after), with up to WINDOW code points around each.

    Matches and the gaps between them give the positions by running sums, in chunks, so that no long array is
    copied for each match.
    """
    none = F.array().cast(_SPAN)
    df = df.withColumn("__m", F.when(when, F.regexp_extract_all(c(text), F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>")))
    df = df.withColumn("__g", F.when(F.size("__m") > 0, F.split(c(text), pattern, -1)))
    # One entry per match: lengths of the gap before and of the match, the match, and what surrounds it.
    tail = F.slice("__g", 2, F.size("__m"))
    cut_before = lambda g: F.when(F.length(g) > WINDOW, F.regexp_replace(F.right(g, F.lit(WINDOW)), r"^\p{L}+", "")).otherwise(g)
    cut_after = lambda g: F.when(F.length(g) > WINDOW, F.regexp_replace(F.left(g, F.lit(WINDOW)), r"\p{L}+$", "")).otherwise(g)
    entry = F.zip_with(
        F.zip_with(F.slice("__g", 1, F.size("__m")), "__m", lambda g, m: F.struct(F.length(g).alias("g"), F.length(m).alias("m"), m.alias("value"),
                                                                                  cut_before(g).alias("before"))),
        tail, lambda e, g: F.struct(e["g"].alias("g"), e["m"].alias("m"), e["value"].alias("value"), e["before"].alias("before"), cut_after(g).alias("after")))
    df = df.withColumn("__e", F.when(F.size("__m") > 0, entry))
    df = df.withColumn("__c", F.when(F.size("__m") > 0, F.transform(
        F.sequence(F.lit(0), F.floor((F.size("__m") - 1) / _CHUNK).cast("int")), lambda k: F.slice("__e", k * _CHUNK + 1, F.lit(_CHUNK)))))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all"))
    offsets = F.aggregate("__c", start, lambda s, part: F.struct(
        (s["at"] + F.aggregate(part, F.lit(0), lambda t, e: t + e["g"] + e["m"])).alias("at"), F.concat(s["all"], F.array(s["at"])).alias("all")), lambda s: s["all"])
    df = df.withColumn("__o", F.when(F.size("__m") > 0, offsets))

    def place(part: Column, offset: Column) -> Column:
        def step(s: Column, e: Column) -> Column:
            begin = s["at"] + e["g"]
            one = F.struct(begin.alias("start"), (begin + e["m"]).alias("end"), e["value"].alias("value"), e["before"].alias("before"), e["after"].alias("after"))
            return F.struct((begin + e["m"]).alias("at"), F.concat(s["all"], F.array(one)).alias("all"))
        return F.aggregate(part, F.struct(offset.alias("at"), none.alias("all")), step, lambda s: s["all"])

    made = F.flatten(F.zip_with("__c", "__o", place))
    return df.withColumn(out, F.coalesce(F.when(F.size("__m") > 0, made), none)).drop("__m", "__g", "__e", "__c", "__o")


def with_entities(docs: DataFrame, text: str) -> DataFrame:
    """Add one column per kind with its valid spans."""
    out = docs
    conditions = {"email": c(text).contains("@"), "ip": c(text).rlike(r"[0-9]\.[0-9]"), "card": c(text).rlike("[0-9][ -]?[0-9]"),
                  "phone": c(text).rlike(r"\+[0-9]")}
    for kind, pattern in _PATTERNS.items():
        out = spans_of(out, text, pattern, f"__{kind}", conditions[kind])
        out = out.withColumn(f"__{kind}", F.filter(f"__{kind}", _is_valid(kind)))
    return out


def _listed(kind: str) -> Column:
    """Spans of a kind as (start, order, end, kind)."""
    return F.transform(f"__{kind}", lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("k"), s["end"].alias("end"),
                                                       F.lit(kind).alias("kind"), F.lit(PLACEHOLDERS[kind]).alias("put")))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, h, n_email, n_ip, n_card, n_phone, base, found) of every row.

    ``h`` is a hash of the text, which tells rows of one id apart; ``base`` are the pattern spans, ``found`` also
    the disclosing terms, both sorted. Null texts are empty. Repeated rows get equal results; other columns are not
    read.
    """
    text = F.coalesce(c(text_col).cast("string"), F.lit(""))
    chosen = docs.select(c(id_col).cast("long").alias("id"), text.alias("text"))
    seen = with_entities(chosen.withColumn("h", F.xxhash64("text")), "text")
    base = F.array_sort(F.concat(*[_listed(k) for k in _PATTERNS]))
    seen = seen.select("id", "h", "text", *[f"__{k}" for k in _PATTERNS]).withColumn("base", base)
    seen = stored(seen.withColumn("terms_of", F.when(F.size("base") > 0, _terms(F.col("text")))).drop("text"), "personal-data")

    # Words around each entity, with their places.
    def named(kind: str) -> Column:
        return F.transform(f"__{kind}", lambda s: F.struct(
            F.concat_ws(":", F.lit(kind), s["value"]).alias("entity"), s["start"].alias("start"), s["end"].alias("end"),
            s["before"].alias("before"), s["after"].alias("after")))

    entities = F.concat(*map(named, _PATTERNS))
    around = seen.filter(F.size("base") > 0).select("id", "h", "base", F.explode(entities).alias("e"))
    sides = around.select("id", "h", "base", "e.entity", F.explode(F.array(
        F.struct(F.col("e.before").alias("part"), (F.col("e.start") - F.length("e.before")).alias("at")),
        F.struct(F.col("e.after").alias("part"), F.col("e.end").alias("at")))).alias("s")).select("id", "h", "base", "entity", "s.part", "s.at")
    words = spans_of(sides, "part", TERM, "w", F.lit(True)).select("id", "h", "base", "entity", "at", F.explode("w").alias("w"))
    words = words.select("id", "h", "base", "entity", F.lower("w.value").alias("term"), (F.col("at") + F.col("w.start")).alias("start"),
                         (F.col("at") + F.col("w.end")).alias("end"))
    free = ~F.exists("base", lambda b: (b["start"] < F.col("end")) & (F.col("start") < b["end"]))
    near = stored(words.filter(free).drop("base"), "personal-words")

    # Corpus statistics over all texts. The pairs and words are folded before they are shuffled.
    pairs = near.groupBy("term", "entity").agg(F.count("*").alias("together"))
    per_entity = near.groupBy("entity").agg(F.count("*").alias("around"))
    counts = chosen.select(F.explode(F.split(F.lower("text"), r"\P{L}+")).alias("term")).filter(F.length("term") >= 3).groupBy("term").agg(F.count("*").alias("total"))
    # An inner join stays above the aggregate; a semi join would move below it and see every occurrence.
    counts = stored(counts.join(pairs.filter(F.col("together") >= SUPPORT).select("term").distinct(), "term"), "personal-terms")
    everything, n_docs = chosen.agg(F.sum(F.length("text")), F.count("*")).first()
    close = pairs.filter(F.col("together") >= SUPPORT).join(counts, "term").join(per_entity, "entity").select(
        "term", (F.col("together") / F.col("total")).alias("share"),
        F.log2(F.col("together") * F.lit(float(max(1, everything or 0))) / 6 / (F.col("total") * F.col("around"))).alias("bits"))

    # The same by documents. As many as ``rare`` is the most that an entity, a word or both can have and reach BITS.
    rare = n_docs / 2 ** BITS
    shown = F.array_distinct(F.transform(entities, lambda e: e["entity"]))
    showing = seen.filter(F.size("base") > 0).select("id", "h", F.explode(shown).alias("entity"))
    in_docs = stored(showing.groupBy("entity").agg(F.count("*").alias("around")).filter(F.col("around").between(SUPPORT, rare)), "personal-entities")
    rows = showing.join(in_docs.select("entity"), "entity").groupBy("id", "h").agg(F.collect_set("entity").alias("shown"))
    rows = rows.select(F.col("id").alias("__id"), F.col("h").alias("__h"), "shown")
    both = seen.join(rows, F.col("id").eqNullSafe(F.col("__id")) & (F.col("h") == F.col("__h"))).select("terms_of", F.explode("shown").alias("entity"))
    both = both.select("entity", F.explode("terms_of").alias("term")).groupBy("term", "entity").agg(F.count("*").alias("together"))
    both = stored(both.filter(F.col("together").between(SUPPORT, rare)), "personal-pairs")
    each = chosen.select("id", F.xxhash64("text").alias("h"), F.explode(_terms(F.col("text"))).alias("term"))
    totals = each.groupBy("term").agg(F.count("*").alias("total")).filter(F.col("total").between(SUPPORT, rare))
    totals = stored(totals.join(both.select("term").distinct(), "term"), "personal-totals")
    wide = both.join(totals, "term").join(in_docs, "entity").select(
        "term", (F.col("together") / F.col("total")).alias("share"),
        F.log2(F.col("together") * F.lit(float(n_docs)) / (F.col("total") * F.col("around"))).alias("bits"))

    disclosing = close.union(wide).filter((F.col("share") >= SHARE) & (F.col("bits") >= BITS)).groupBy("term").agg(
        F.when(F.max("share") >= REMOVE, "").otherwise("<TERM>").alias("put"))
    disclosing = stored(disclosing, "personal-disclosing")

    # All places of the disclosing terms, in every text that has one.
    hits = each.join(disclosing, "term").groupBy("id", "h").agg(F.map_from_entries(F.collect_set(F.struct("term", "put"))).alias("puts"))
    hits = stored(hits.select(F.col("id").alias("__id"), F.col("h").alias("__h"), "puts"), "personal-hits")
    texts = chosen.withColumn("h", F.xxhash64("text")).join(hits, F.col("id").eqNullSafe(F.col("__id")) & (F.col("h") == F.col("__h")))
    places = spans_of(texts.select("id", "h", "text", "puts"), "text", TERM, "w", F.lit(True))
    named_terms = F.filter(F.transform("w", lambda w: F.struct(
        w["start"].alias("start"), F.lit(KINDS.index("term")).alias("k"), w["end"].alias("end"), F.lit("term").alias("kind"),
        F.try_element_at("puts", F.lower(w["value"])).alias("put"))), lambda t: t["put"].isNotNull())
    marked = places.select("id", "h", named_terms.alias("terms")).dropDuplicates(["id", "h"])
    marked = stored(marked, "personal-marks").select(F.col("id").alias("__id"), F.col("h").alias("__h"), "terms")
    joined = seen.join(marked, F.col("id").eqNullSafe(F.col("__id")) & (F.col("h") == F.col("__h")), "left")
    terms = F.filter(F.coalesce("terms", F.array().cast(joined.schema["terms"].dataType)),
                     lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    found = F.array_sort(F.concat("base", terms))
    return joined.select("id", "h", *[F.size(f"__{k}").cast("long").alias(f"n_{k}") for k in _PATTERNS], "base", found.alias("found"))


def personal_data_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row."""
    found = find_personal_data(docs, id_col, text_col)
    return found.select(F.col("id").alias(id_col), *[f"n_{k}" for k in _PATTERNS], F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        _joined(F.col("found")).alias("spans"))


def sanitised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with entities replaced by placeholders and disclosing terms generalised or removed; a null text stays null.

    Overlapping spans are replaced once, from the first start to the last end.
    """
    found = find_personal_data(docs, id_col, text_col).filter(F.size("found") > 0).select(
        F.col("id").alias("__id"), F.col("h").alias("__h"), F.col("found").alias("__found"))
    found = stored(found.dropDuplicates(["__id", "__h"]), "personal-found")
    text = c(text_col).cast("string")
    joined = docs.join(found, c(id_col).cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col("__h")), "left")

    def step(s: Column, x: Column) -> Column:
        gap = F.substring(text, s["at"] + 1, F.greatest(x["start"] - s["at"], F.lit(0)))
        put = F.when(x["start"] >= s["at"], x["put"]).otherwise("")
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), F.concat(s["out"], F.array(gap, put)).alias("out"))

    clean = F.aggregate("__found", F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")), step,
                        lambda s: F.concat(F.array_join(s["out"], ""), F.substring(text, s["at"] + 1, F.length(text))))
    changed = F.when(F.col("__found").isNotNull(), clean).otherwise(text)
    return joined.select(*[changed.alias(x) if x == text_col else c(x) for x in docs.columns])
