"""Personal data, and the terms around it that disclose it.

Protected entities are the values of emails, addresses of machines, cards and phone numbers, found by
patterns. A term of a document that holds an entity discloses it by as much as the
corpus says: pointwise mutual information log2(N * n(term, entity) / (n(term) * n(entity))), where n counts
documents; with ``reach``, only terms within so many characters are together with an entity. It is set against the information content of the entity, log2(N / n(entity)): a share of 1 says
that the term occurs with the entity alone. Terms with a share of ``threshold`` or more are personal
data too wherever they stand, in documents without the entity as well: those that occur with it alone are
removed, the others generalised to a placeholder. Terms are counted with each value, and with its classes: mail domain,
/24 net, first six digits of a card, first four of a phone number, and the kind, so that values in one text
are protected by what the corpus says of their like. A share is smoothed by its evidence: each text with both
after the first says log2(N / n(entity)) bits against chance, and the share is multiplied by
bits / (bits + ``smoothing``); copies of one text are one piece of evidence. Built-in functions only.

All documents' terms are counted once, with partial counts first. A pair (entity, term) is only formed where its share can
reach the threshold t: n(both) is at most n(entity), and at most the documents in which the term stands with any entity. So a term
needs the share (n(term) / N) ** ((1 - t) / t) of its documents among those, and an entity needs
(n(term) / N ** (1 - t)) ** (1 / t) documents; what only one text holds has no evidence. Common words meet no entity then,
and a text with thousands of entities that share a domain or net pairs its terms with these, not with each value.

Defined results: null text has no spans. Terms are runs of letters in lower case, of three letters or more. An
entity that every document holds can't be disclosed. Repeated rows get the same spans; they are counted as
documents. Very long texts are read whole. Columns other than doc_id and text are not read (``sanitised`` keeps those of documents). An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortmill.llm import spans
from cohortmill.llm.common import documents_only
from cohortmill.llm.spans import Rule
from cohortmill.sources.checkpoints import written

THRESHOLD = 0.8
#: Bits of evidence that halve a share, see above.
SMOOTHING = 3.0
TERM = r"\p{L}{3,}"
#: Largest table of terms, or of documents that hold some, that is sent to every task.
BROADCAST_BYTES = 16 << 20
PLACEHOLDERS = {"email": "<EMAIL>", "ip": "<IP>", "card": "<CARD>", "phone": "<PHONE>", "term": "<TERM>"}


def _part() -> str:
    return r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether up to 19 digits pass the checksum: every second digit from the right, doubled, as its digits' sum."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda digit: F.coalesce(digit.try_cast("int"), F.lit(0)))
    doubled = F.transform(each, lambda d, i: F.when(i % 2 == 0, d).otherwise(F.when(d > 4, d * 2 - 9).otherwise(d * 2)))
    return F.aggregate(doubled, F.lit(0), lambda total, d: total + d) % 10 == 0


# The same matches as the plain patterns give, written so that a long run without a match takes linear time: a match
# begins where a run of its first class begins, or where the last match ended, and loops never give back.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

RULES = [
    Rule("email", EMAIL, r"@[A-Za-z0-9-]++\.[A-Za-z0-9-]"),
    Rule("ip", IP, r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", lambda value: value.rlike(rf"^{_part()}(?:\.{_part()}){{3}}$")),
    Rule(
        "card",
        CARD,
        r"[0-9](?:[\x20-]?[0-9]){15}",
        lambda value: F.length(_digits(value)).between(16, 19) & luhn(_digits(value)),
    ),
    Rule("phone", PHONE, r"\+[0-9][\x20().0-9-]", lambda value: F.length(_digits(value)).between(8, 15)),
]
KINDS = [rule.kind for rule in RULES]


def personal(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, text and ``found``, the spans with values by kind, then start."""
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    placed = spans.found(texts, "text", RULES)
    return placed.select("doc_id", "text", F.concat(*[F.col(f"_{kind}") for kind in KINDS]).alias("found"))


def _names(span: Column) -> Column:
    """What a span's value stands for: itself, its class (mail domain, /24 net, first digits) and its kind."""
    kind, value = span["kind"], F.lower(span["value"])
    part = (
        F.when(kind == "email", F.substring_index(value, "@", -1))
        .when(kind == "ip", F.substring_index(value, ".", 3))
        .when(kind == "card", F.substring(_digits(value), 1, 6))
        .otherwise(F.substring(_digits(value), 1, 4))
    )
    return F.array(F.concat_ws(":", kind, value), F.concat_ws(" of ", kind, part), kind)


def near_terms(found: DataFrame, reach: int) -> DataFrame:
    """Terms near entities: doc_id, digest (of the text), entity, term, start, end. Words cut by the end of what is
    read, or part of a span, are left out with their neighbourhood's edge."""
    mentions = found.filter(F.size("found") > 0)
    span = F.explode("found").alias("span")
    mentions = mentions.select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"), "text", "found", span)
    # One character more on either side tells whether a word goes on there.
    before = F.greatest(F.col("span.start") - reach - 1, F.lit(0)).cast("int")
    left = F.substring("text", before + 1, (F.col("span.start") - before).cast("int"))
    right = F.substring("text", (F.col("span.end") + 1).cast("int"), F.lit(reach + 1))
    sides = F.array(
        F.struct(before.cast("bigint").alias("base"), left.alias("side")),
        F.struct(F.col("span.end").alias("base"), right.alias("side")),
    )
    entity = _names(F.col("span"))
    inner = F.transform("found", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    close = F.filter(
        inner, lambda s: (s["end"] >= F.col("span.start") - reach - 1) & (s["start"] <= F.col("span.end") + reach + 1)
    )
    rows = mentions.select("doc_id", "digest", entity.alias("entity"), close.alias("close"), F.explode(sides).alias("s"))
    rows = rows.select("doc_id", "digest", "entity", "close", "s.base", "s.side")
    placed = spans.found(rows, "side", [Rule("term", TERM, r"\p{L}{3}")])
    each = placed.select("doc_id", "digest", "entity", "close", "base", F.length("side").alias("n"), F.explode("_term").alias("t"))
    start, end = F.col("base") + F.col("t.start"), F.col("base") + F.col("t.end")
    whole = ((F.col("t.start") > 0) | (F.col("base") == 0)) & (F.col("t.end") < F.col("n"))
    whole = whole | ((F.col("t.end") == F.col("n")) & (F.col("n") <= reach) & (F.col("t.start") > 0))
    terms = each.filter(whole).select(
        "doc_id", "digest", "entity", "close", F.lower("t.value").alias("term"), start.alias("start"), end.alias("end")
    )
    apart = ~F.exists("close", lambda s: (s["start"] < F.col("end")) & (F.col("start") < s["end"]))
    terms = terms.filter(apart).drop("close")
    return terms.withColumn("entity", F.explode("entity"))


def plain(text: Column) -> Column:
    """Lower case, code point by code point (only one capital letter would become two)."""
    return F.lower(F.translate(text, "\u0130", "i"))


def _words(text: Column) -> Column:
    """The different runs of letters of a plain text; those of less than three letters are no terms."""
    return F.array_distinct(F.split(text, r"\P{L}+"))


def _terms(rows: DataFrame, words: Column, *keep: str) -> DataFrame:
    """One row for each term, with the kept columns."""
    # The outer form, as else a filter on the array's size would cut every text twice.
    each = rows.select(*keep, F.explode_outer(words).alias("term"))
    return each.filter(F.length("term") >= 3)


def _replaced(changes: Column, by: Callable[[Column, Column], Column]) -> Column:
    """The text with spans (start, end, ...), in order, replaced by what ``by`` gives for a span and where it begins."""
    begin = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(state: Column, change: Column) -> Column:
        width = F.greatest(change["start"] - state["at"], F.lit(0)).cast("int")
        gap = F.substring(F.col("text"), (state["at"] + 1).cast("int"), width)
        # Where a span begins inside the last one, only what goes beyond it is left out.
        parts = F.concat(state["parts"], F.array(gap, by(change, state["at"])))
        return F.struct(F.greatest(state["at"], change["end"]).alias("at"), parts.alias("parts"))

    def finish(state: Column) -> Column:
        return F.concat(F.array_join(state["parts"], ""), F.substring(F.col("text"), (state["at"] + 1).cast("int"), F.length("text")))

    return F.aggregate(changes, begin, step, finish)


def _masked() -> Column:
    """The text with blanks in place of the entities, so that their own words are no terms."""
    spans_of = F.array_sort(F.transform("found", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    return _replaced(
        spans_of, lambda s, at: F.repeat(F.lit(" "), F.greatest(s["end"] - F.greatest(s["start"], at), F.lit(0)).cast("int"))
    )


def _small(table: DataFrame, *size: Column) -> DataFrame | None:
    """A written table marked to be sent to every task, where the sum of its rows' sizes allows that."""
    total = table.agg(F.sum(sum(size, F.lit(16)))).first()[0] or 0
    return F.broadcast(table) if total <= BROADCAST_BYTES else None


def term_counts(docs: DataFrame, texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """hash (of a term) and n_term, the documents that hold it outside of entities; texts: rows, plain and masked of
    those that hold entities; wanted: a written table of the terms that are asked for (others may be counted too)."""
    one = F.lit(1).cast("bigint").alias("n")
    counts = _terms(docs.select(plain(F.col("text")).alias("plain")), _words(F.col("plain"))).select("term", one)
    # What the words of entities change in that.
    held, rest = _words(F.col("plain")), _words(F.col("masked"))
    less = _terms(texts, F.array_except(held, rest), "rows").select("term", (-F.col("rows")).alias("n"))
    more = _terms(texts, F.array_except(rest, held), "rows").select("term", F.col("rows").alias("n"))
    counts = counts.unionByName(less).unionByName(more).select(F.xxhash64("term").alias("hash"), "n")
    # Where they are few, other terms are left out before the shuffle.
    few = _small(wanted.select(F.xxhash64("term").alias("_hash")))
    if few is not None:
        counts = counts.join(few, F.col("hash") == F.col("_hash"), "left_semi")
    return counts.groupBy("hash").agg(F.sum("n").alias("n_term"))


def disclosing(
    docs: DataFrame, found: DataFrame, reach: int | None = None, threshold: float = THRESHOLD, smoothing: float = SMOOTHING
) -> DataFrame:
    """(entity, term, share, alone): pairs whose share of disclosure reaches the threshold; found: doc_id, digest,
    text, plain, found and masked."""
    total = float(docs.count())
    if reach is None:
        found = found.drop("text")
    # Documents are counted by rows of the table, each text once with the number of its rows.
    rows_of = found.groupBy(F.col("digest").alias("_digest")).agg(F.count(F.lit(1)).alias("rows"))
    texts = found.dropDuplicates(["digest"]).join(rows_of, F.col("digest") == F.col("_digest")).drop("_digest")
    texts = written(texts)
    each = F.array_distinct(F.flatten(F.transform("found", _names)))
    held = texts.select("digest", "rows", F.explode(each).alias("entity"))
    entities = held.groupBy(F.col("entity").alias("_entity"))
    entities = entities.agg(F.sum("rows").alias("n_entity"), F.count(F.lit(1)).alias("texts"))
    # What a single text holds has no evidence, so a share of 0; what all documents hold has no content.
    entities = written(entities.filter((F.col("texts") > 1) & (F.col("n_entity") < total)).drop("texts"))
    known = held.join(entities, F.col("entity") == F.col("_entity")).select("digest", "rows", "entity", "n_entity")
    # Terms that can disclose anything: concentrated in documents with entities.
    here = written(_terms(texts, _words(F.col("masked")), "digest", "rows"))
    among = here.groupBy("term").agg(F.sum("rows").alias("n_held"), F.count(F.lit(1)).alias("texts")).filter("texts > 1")
    among = written(among)
    among = among.join(term_counts(docs, texts, among), F.xxhash64("term") == F.col("hash"))
    least = F.pow(F.col("n_term") / total, F.lit((1 - threshold) / threshold)) if threshold > 0 else F.lit(0.0)
    # A millionth less, as these are rounded numbers.
    among = written(among.filter(F.col("n_held") / F.col("n_term") >= least * (1 - 1e-6)).select(F.col("term").alias("_term"), "n_term"))
    few = _small(among, F.octet_length("_term"))
    here = here.join(among if few is None else few, F.col("term") == F.col("_term")).select("digest", "term", "n_term")
    if reach is not None:
        near = near_terms(texts.withColumn("text", F.col("plain")), reach)
        near = near.select(F.col("digest").alias("_digest"), F.col("entity").alias("_near"), F.col("term").alias("_term")).distinct()
    terms = here.groupBy(F.col("digest").alias("_digest")).agg(F.collect_list(F.struct("term", "n_term")).alias("terms"))
    # A text's own terms, no more than its words.
    both = known.join(terms, F.col("digest") == F.col("_digest"))
    few = F.pow(F.col("n_entity").cast("double"), F.lit(threshold)) * total ** (1 - threshold) * (1 + 1e-6)
    both = both.select("digest", "rows", "entity", "n_entity", F.explode(F.filter("terms", lambda t: t["n_term"] <= few)).alias("t"))
    both = both.select("digest", "rows", "entity", "n_entity", "t.term", "t.n_term")
    if reach is not None:
        match = (F.col("digest") == F.col("_digest")) & (F.col("entity") == F.col("_near")) & (F.col("term") == F.col("_term"))
        both = both.join(near, match, "left_semi")
    pairs = both.groupBy("entity", "term", "n_entity", "n_term").agg(F.sum("rows").alias("n_both"), F.count(F.lit(1)).alias("texts"))
    pairs = pairs.filter("texts > 1")
    content = F.log2(F.lit(total) / F.col("n_entity"))
    information = F.log2(F.lit(total) * F.col("n_both") / (F.col("n_term") * F.col("n_entity")))
    bits = (F.col("texts") - 1) * content
    share = information / content * bits / (bits + smoothing)
    told = pairs.select("entity", "term", share.alias("share"), (F.col("n_both") >= F.col("n_term")).alias("alone"))
    return told.filter(F.col("share") >= threshold)


def holders(docs: DataFrame, told: DataFrame) -> DataFrame:
    """Documents that hold told terms (_term, alone; a written table): doc_id, digest, text and ``held``, the terms with whether
    they are alone. Tables are sent to all tasks where they are small by their measured size, else they are shuffled."""
    texts = docs.filter(F.col("text").isNotNull())
    texts = texts.select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"), "text")
    few = _small(told, F.octet_length("_term"))
    each = _terms(texts, _words(plain(F.col("text"))), "doc_id", "digest")
    each = each.join(told if few is None else few, F.col("term") == F.col("_term"))
    held = each.groupBy(F.col("doc_id").alias("_doc_id"), F.col("digest").alias("_digest"))
    held = written(held.agg(F.collect_set(F.struct("term", "alone")).alias("held")))
    few = _small(held, F.octet_length("_digest"), F.size("held") * 32)
    match = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("digest") == F.col("_digest"))
    return texts.join(held if few is None else few, match).drop("_doc_id", "_digest")


def detect(
    docs: DataFrame, reach: int | None = None, threshold: float = THRESHOLD, smoothing: float = SMOOTHING
) -> DataFrame:
    """Per document with any: doc_id, digest (of its text), found (kind, start, end of entities) and terms (start, end of
    disclosing terms, and whether they occur with an entity alone). Repeated rows are one."""
    found = personal(docs).filter(F.size("found") > 0)
    own = plain(F.col("text")).alias("plain")
    found = found.select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"), "text", own, "found", _masked().alias("masked"))
    found = written(found.withColumn("masked", plain(F.col("masked"))))
    # A term that discloses several entities is removed if it occurs with any of them alone.
    told = disclosing(docs, found, reach, threshold, smoothing).groupBy(F.col("term").alias("_term")).agg(F.max("alone").alias("alone"))
    holding = holders(docs, written(told))
    # Entities are searched anew in these texts, which are a part of all, so that no texts are shuffled.
    holding = spans.found(holding, "text", RULES).withColumn("found", F.concat(*[F.col(f"_{kind}") for kind in KINDS]))
    holding = holding.withColumn("masked", plain(_masked()))
    # The text's own terms alone are looked for; they are nothing but letters.
    terms = F.array_join(F.transform("held", lambda h: h["term"]), "|")
    pattern = F.concat(F.lit(r"(?<!\p{L})(?:"), terms, F.lit(r")(?!\p{L})"))
    placed = holding.withColumns({"_values": F.regexp_extract_all("masked", pattern, F.lit(0)), "_gaps": F.split("masked", pattern, -1)})
    alone = F.map_from_entries("held")
    found_terms = spans.placed("term", F.slice("_gaps", F.lit(1), F.size("_values")), F.col("_values"))
    marks = F.transform(found_terms, lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), alone[t["value"]].alias("alone")))
    bare = F.transform("found", lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    marked = written(placed.select("doc_id", "digest", bare.alias("found"), marks.alias("terms")).dropDuplicates(["doc_id", "digest"]))
    done = marked.select(F.col("doc_id").alias("_doc_id"), F.col("digest").alias("_digest"))
    match = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("digest") == F.col("_digest"))
    others = found.select("doc_id", "digest", bare.alias("found")).dropDuplicates(["doc_id", "digest"]).join(done, match, "left_anti")
    none = F.array().cast("array<struct<start:bigint,end:bigint,alone:boolean>>")
    return marked.unionByName(others.withColumn("terms", none))


def report(docs: DataFrame, reach: int | None = None, threshold: float = THRESHOLD, smoothing: float = SMOOTHING) -> DataFrame:
    """Counts per kind, digest of the plain patterns' spans, and all spans as text, for every row."""
    terms = F.transform(
        "terms", lambda t: F.struct(F.lit("term").alias("kind"), t["start"].alias("start"), t["end"].alias("end"))
    )
    found = detect(docs, reach, threshold, smoothing).withColumn("terms", terms)
    # Repeated rows have the same spans.
    found = found.withColumnsRenamed({"doc_id": "_doc_id", "digest": "_digest"})
    texts = docs.select("doc_id", F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("digest"))
    match = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("digest") == F.col("_digest"))
    empty = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    rows = texts.join(found, match, "left")
    rows = rows.select("doc_id", F.coalesce("found", empty).alias("found"), F.coalesce("terms", empty).alias("terms"))
    counts = [F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}") for kind in KINDS]
    base = spans.listed(F.col("found"))
    return rows.select(
        "doc_id",
        *counts,
        F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        spans.listed(F.concat("found", "terms")).alias("spans"),
        F.size("terms").cast("long").alias("n_term"),
    )


def sanitised(docs: DataFrame, reach: int | None = None, threshold: float = THRESHOLD, smoothing: float = SMOOTHING) -> DataFrame:
    """The documents with placeholders for entities and generalised terms, and without removed terms."""
    docs = documents_only(docs)
    named = detect(docs, reach, threshold, smoothing)
    holder = F.create_map(*[F.lit(x) for pair in PLACEHOLDERS.items() for x in pair])
    entity = F.transform(
        "found", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), holder[s["kind"]].alias("by"))
    )
    term = F.transform(
        "terms",
        lambda t: F.struct(
            t["start"].alias("start"), t["end"].alias("end"), F.when(t["alone"], "").otherwise(PLACEHOLDERS["term"]).alias("by")
        ),
    )
    named = named.select(F.col("doc_id").alias("_doc_id"), F.col("digest").alias("_digest"), F.array_sort(F.concat(entity, term)).alias("_changes"))
    keyed = docs.withColumn("_own", F.md5(F.col("text").cast("binary")))
    match = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("_own") == F.col("_digest"))
    joined = keyed.join(named, match, "left")
    text = _replaced(F.col("_changes"), lambda change, at: F.when(change["start"] < at, "").otherwise(change["by"]))
    joined = joined.withColumn("text", F.when(F.col("_changes").isNotNull(), text).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return joined.select(*docs.columns)
