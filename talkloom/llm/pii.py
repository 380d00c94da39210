"""Personal data: base patterns, and terms that give the protected entities away (information-theoretic sanitisation).

Base kinds are leftmost non-overlapping matches of fixed patterns with checks (email, ip, card, phone). Their offsets come from the
pieces between and the matches themselves, both of one regular expression, so only column functions are used. Patterns carry look
behinds and possessive repeats that find the same matches in linear time on long runs.

Terms: protected entities are the values of base matches and, as most values are rare, the pools they belong to (mail domain, network of an
address, issuer of a card, all but the last digits of a phone). An entity's information is IC(e) = -log2 p(e), and a term t of the same
document reveals PMI(t, e) = log2(p(e | t) / p(e)), where probabilities are shares of documents. p(e | t) is not taken as counted, but as the
lower end of its Wilson interval, `z` deviations wide, so that a few chance meetings reveal little. Candidates are all words of at
least `min_chars` letters outside base matches, however far from the entity, that `support` documents have together with it and most of whose documents
(`share`) hold it. A term that reveals at least `remove` of some IC(e) is removed, one that reveals at least `generalise` of it is generalised, at every
occurrence in every document, also where the entity is not spelled out; both are spans of kind "term", and base spans stay.

Near copies repeat each other, so all counts are over originals together with their copies: of each document four minima of hashed shingles of five words are taken, and a
document that shares three of them with documents of smaller rank is a copy (similarity 0.8: 0.82 of the copies, 0.95: 0.99; similarity 0.2: 0.03). A copy goes with the
document it shares most with. What stands in any of them counts, once: all documents are read for entities, pairs and terms. Copies are sanitised like all others.

Null text is empty and has no spans. Rows of equal doc_id are told apart by their texts; rows equal in both get equal spans. Offsets are code points, ends
exclusive. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkloom.llm.tables import FEW_ROWS, few, written

#: Fixed patterns of the base kinds, in the order of their output.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a kind to be looked for; cheaper than the pattern.
_HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
KINDS = (*PATTERNS, "term")

MIN_CHARS = 4
SUPPORT = 3
REMOVE, GENERALISE = 0.9, 0.6
#: Deviations of the interval, and the least share of a term's documents that hold the entity.
Z, SHARE = 3.0, 0.5
#: Words of a shingle, and how many of the four minima a copy shares.
SHINGLE, SHARED = 5, 3
#: Documents with copies up to which their table, two numbers a row, is broadcast.
COPY_ROWS = 1_000_000
_FLIP = 0x5555555555555555

_SPAN = "array<struct<kind:string,start:int,end:int,value:string>>"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    each = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(F.element_at(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), c.cast("int") + 1)))
    return F.aggregate(each, F.lit(0), lambda a, b: a + b) % 10 == 0


def _passes(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.rlike(match, F.lit(r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"))
    if kind == "card":
        n = F.length(_digits(match))
        return F.when(n.between(16, 19), _luhn(_digits(match))).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(match)).between(8, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """All base spans of a text, by kind and start."""
    found = []
    for kind, pattern in PATTERNS.items():
        gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        ends = F.aggregate(
            F.zip_with(hits, gaps, lambda h, g: F.struct(h.alias("h"), g.alias("g"))),
            F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out")),
            lambda acc, x: F.struct(
                (acc["at"] + F.length(x["g"]) + F.coalesce(F.length(x["h"]), F.lit(0))).alias("at"),
                F.when(
                    x["h"].isNotNull() & _passes(kind, x["h"]),
                    F.concat(acc["out"], F.array(F.struct(F.lit(kind).alias("kind"), (acc["at"] + F.length(x["g"])).alias("start"), (acc["at"] + F.length(x["g"]) + F.length(x["h"])).alias("end"), x["h"].alias("value")))),
                ).otherwise(acc["out"]).alias("out"),
            ),
            lambda acc: acc["out"],
        )
        hint = F.contains(text, F.lit(_HINTS[kind])) if _HINTS[kind] else F.lit(True)
        if kind != "email":
            hint = hint & F.rlike(text, F.lit("[0-9]"))
        found.append(F.when(hint, ends).otherwise(F.array().cast(_SPAN)))
    return F.concat(*found)


def _words(text: Column) -> Column:
    """Distinct words (runs of letters) of a text as they are spelled."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"\p{L}+"), F.lit(0)))


def _pool(kind: Column, value: Column) -> Column:
    """The larger group a value belongs to."""
    digits = _digits(value)
    return (
        F.when(kind == "email", F.substring_index(value, "@", -1))
        .when(kind == "ip", F.substring_index(value, ".", 3))
        .when(kind == "card", F.substring(digits, 1, 6))
        .otherwise(F.substring(digits, F.lit(1), F.length(digits) - 4))
    )


def _entities(held: DataFrame) -> DataFrame:
    """_doc, entity: the values of a document's base spans and their pools."""
    spans = held.select("_doc", F.explode("base").alias("s")).select("_doc", "s.kind", F.lower("s.value").alias("value"))
    both = F.array(F.concat_ws(":", "kind", "value"), F.concat_ws(":", F.lit("pool"), F.col("kind"), _pool(F.col("kind"), F.col("value"))))
    return spans.select("_doc", F.explode(both).alias("entity")).distinct()


def _once(value: Column, use) -> Column:
    """use(value), with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def minima(text: Column, shingle: int = SHINGLE) -> Column:
    """Least and greatest hash of a text's shingles, and the same of the hashes with half of their bits flipped."""
    words = F.split(F.lower(text), r"\P{L}+")
    hashes = _once(words, lambda ws: F.transform(ws, lambda _, i: F.xxhash64(F.slice(ws, i + 1, shingle))))
    flipped = lambda hs: F.transform(hs, lambda h: h.bitwiseXOR(F.lit(_FLIP)))
    return _once(hashes, lambda hs: F.array(F.array_min(hs), F.array_max(hs), F.array_min(flipped(hs)), F.array_max(flipped(hs))))


def _marks(rows: DataFrame) -> DataFrame:
    return written(rows.select("_doc", F.posexplode(minima(F.col("text"))).alias("nth", "mark")).distinct())


def _firsts(marks: DataFrame) -> DataFrame:
    return marks.groupBy("nth", "mark").agg(F.min("_doc").alias("first"))


def _copies(marks: DataFrame, shared: int) -> DataFrame:
    least = _firsts(marks).groupBy(F.col("first").alias("_doc")).agg(F.count(F.lit(1)).alias("own")).filter(F.col("own") > 4 - shared)
    return marks.filter("nth = 0").select("_doc").join(least, "_doc", "left_anti").distinct()


def copies(rows: DataFrame, shared: int = SHARED) -> DataFrame:
    """_doc of the documents that share at least `shared` of their four minima with documents of smaller _doc."""
    return _copies(_marks(rows), shared)


def originals(rows: DataFrame, shared: int = SHARED) -> DataFrame:
    """_doc, original: for every copy the document it goes with, which is none; copies of copies go with the same one."""
    marks = _marks(rows)
    known = written(_copies(marks, shared))
    owned = marks.join(known, "_doc").join(_firsts(marks), ["nth", "mark"]).filter("first < _doc").groupBy("_doc", "first").agg(F.count(F.lit(1)).alias("n"))
    gone = written(owned.groupBy("_doc").agg(F.max_by("first", F.struct("n", -F.col("first"))).alias("original")))
    while True:
        # a copy goes with a document of smaller _doc, so this ends; each turn halves what lies between
        beyond = gone.select(F.col("_doc").alias("original"), F.col("original").alias("beyond"))
        if gone.join(beyond, "original", "left_semi").isEmpty():
            return gone
        gone = written(gone.join(beyond, "original", "left").select("_doc", F.coalesce("beyond", "original").alias("original")))


def _at_least(hits: Column, of: Column, z: float) -> Column:
    """Lower end of the Wilson interval of hits / of."""
    p, q = hits / of, F.lit(z * z) / of
    return (p + q / 2 - z * F.sqrt(p * (1 - p) / of + q / (4 * of))) / (1 + q)


def _occurrences(text: Column, base: Column, spelled: Column) -> Column:
    """start, end, removed of every occurrence of the spelled words (struct word, removed) as whole words that overlap no base span.

    One pass: the spelled words, which are letters only, make up one pattern.
    """
    pattern = F.concat(F.lit(r"(?<!\p{L})(?:"), F.array_join(F.transform(spelled, lambda w: w["word"]), "|"), F.lit(r")(?!\p{L})"))
    kinds = F.map_from_entries(F.transform(spelled, lambda w: F.struct(w["word"], w["removed"])))
    found = F.zip_with(F.regexp_extract_all(text, pattern, F.lit(0)), F.split(text, pattern, -1), lambda h, g: F.struct(h.alias("h"), F.length(g).alias("gap")))
    placed = F.aggregate(
        F.filter(found, lambda x: x["h"].isNotNull()),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,word:string>>").alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + F.length(x["h"])).alias("at"), F.concat(acc["out"], F.array(F.struct((acc["at"] + x["gap"]).alias("start"), x["h"].alias("word")))).alias("out")
        ),
        lambda acc: acc["out"],
    )
    clear = lambda t: ~F.exists(base, lambda b: (b["start"] < t["start"] + F.length(t["word"])) & (b["end"] > t["start"]))
    span = lambda by: lambda t: F.struct(t["start"].alias("start"), (t["start"] + F.length(t["word"])).alias("end"), by[t["word"]].alias("removed"))
    return _once(kinds, lambda by: F.transform(F.filter(placed, clear), span(by)))


def disclosures(rows: DataFrame, min_chars: int = MIN_CHARS, support: int = SUPPORT, z: float = Z, share: float = SHARE) -> DataFrame:
    """entity, term, n_pair, n_term, n_entity, n, reveals (share of IC) of all supported pairs. rows: _doc, text, base."""
    gone = written(originals(rows))
    held = written(rows.filter(F.size("base") > 0).select("_doc", "text", "base"))
    of = written(_entities(held).join(few(gone), "_doc", "left").select("_doc", "entity", F.coalesce("original", "_doc").alias("place")))
    entities = written(of.select("entity", "place").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity")).filter(F.col("n_entity") >= support))
    common = of.join(few(entities.select("entity")), "entity")
    outside = F.aggregate("base", F.col("text"), lambda acc, s: F.replace(acc, s["value"], F.lit(" ")))
    words = held.select("_doc", F.explode(F.array_distinct(F.split(F.lower(outside), r"\P{L}+"))).alias("term")).filter(F.length("term") >= min_chars).distinct()
    met = common.join(words, "_doc").select("entity", "term", "place").distinct()
    pairs = written(met.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_pair")).filter(F.col("n_pair") >= support))
    # documents without copies are counted, the others' words once for all that go together
    together = written(gone.union(gone.select("original", "original").distinct()).toDF("_doc", "place"))
    wanted = written(pairs.select("term").distinct())
    said = rows.select("_doc", "text").join(few(together, COPY_ROWS), "_doc", "left")
    said = said.select("place", F.explode(F.array_distinct(F.split(F.lower("text"), r"\P{L}+"))).alias("term")).filter(F.length("term") >= min_chars)
    said = said.join(F.broadcast(wanted), "term", "left_semi") if wanted.limit(FEW_ROWS + 1).count() <= FEW_ROWS else said
    said = said.groupBy("term", "place").agg(F.count(F.lit(1)).alias("n"))
    terms = said.groupBy("term").agg(F.sum(F.when(F.col("place").isNull(), F.col("n")).otherwise(1)).alias("n_term"))
    total = rows.select("_doc").distinct().join(few(gone), "_doc", "left_anti").agg(F.count(F.lit(1)).alias("n"))
    met = pairs.join(entities, "entity").join(terms, "term").withColumn("n", total.scalar()).filter(F.col("n_entity") < F.col("n"))
    met = met.filter(F.col("n_pair") >= share * F.col("n_term"))
    rare = F.col("n") / F.col("n_entity")
    return met.withColumn("reveals", F.log2(_at_least(F.col("n_pair"), F.greatest("n_term", "n_pair"), z) * rare) / F.log2(rare))


def find(
    docs: DataFrame, min_chars: int = MIN_CHARS, support: int = SUPPORT, remove: float = REMOVE, generalise: float = GENERALISE, z: float = Z, share: float = SHARE
) -> DataFrame:
    """doc_id, text, base, terms: base spans and the terms that reveal them."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("_doc"), base_spans(F.col("text")).alias("base"))
    known = disclosures(rows, min_chars, support, z, share).filter(F.col("reveals") >= generalise)
    known = few(written(known.groupBy("term").agg((F.max("reveals") >= remove).alias("removed"))))
    spelled = rows.select("_doc", F.explode(_words(F.col("text"))).alias("word")).withColumn("term", F.lower("word")).join(known, "term")
    hits = spelled.groupBy(F.col("_doc").alias("_of")).agg(F.collect_set(F.struct("word", "removed")).alias("_hits"))
    joined = rows.join(hits, F.col("_doc") == F.col("_of"), "left")
    none = F.array().cast("array<struct<start:int,end:int,removed:boolean>>")
    terms = F.when(F.col("_hits").isNull(), none).otherwise(_occurrences(F.col("text"), F.col("base"), F.col("_hits")))
    return joined.select("doc_id", "text", "base", terms.alias("terms"))


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def all_spans(base: Column, terms: Column) -> Column:
    one = F.array_distinct(F.transform(terms, lambda t: F.struct(F.lit("term").alias("kind"), t["start"].alias("start"), t["end"].alias("end"))))
    return F.concat(F.transform(base, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))), one)


def sanitised(text: Column, base: Column, terms: Column) -> Column:
    """The text with base matches as "[KIND]", generalised terms as "[TERM]" and removed terms left out.

    Where spans overlap, the one that starts first (the longer of two) stands for both.
    """
    marks = F.concat(
        F.transform(base, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("far"), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("by"))),
        F.transform(terms, lambda t: F.struct(t["start"].alias("start"), (-t["end"]).alias("far"), F.when(t["removed"], F.lit("")).otherwise(F.lit("[TERM]")).alias("by"))),
    )
    done = F.aggregate(
        F.sort_array(marks),
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, m: F.when(
            m["start"] >= acc["at"],
            F.struct((-m["far"]).alias("at"), F.concat(acc["out"], F.substring(text, acc["at"] + 1, m["start"] - acc["at"]), m["by"]).alias("out")),
        ).otherwise(F.struct(F.greatest(acc["at"], -m["far"]).alias("at"), acc["out"].alias("out"))),
    )
    return F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))
