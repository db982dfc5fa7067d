"""Personal data: patterns, and terms that give the protected values away.

Base spans are e-mail and IP addresses, card and telephone numbers. The protected
entities are their values and the part that a value shares with others of its owner or
place: an address's domain, the first half of an IP address, the first six digits of a
number. How strongly a term reveals an entity is measured over the corpus: with
pmi = log2(p(e, t) / (p(e) p(t))) and the entity's information ic = -log2 p(e), the
ratio pmi / ic is 1 where the term never occurs without the entity. Probabilities
count distinct texts, so copies of one text prove nothing, and one text that has both
is no evidence: ``support`` texts are needed, and where fewer than ``firm`` have both,
``smoothing`` is added to the texts of each. Rare words meet by chance as well, so the
texts that have both must also tell more, at pmi bits each, than picking this pair
among all entities and terms takes. Terms are the words of all texts that hold a
mention, however far from it. From ``generalise_at`` on a term is replaced by a class
name, from ``remove_at`` on it is removed, at every place where it stands, in texts
without the entity as well.

Offsets are code points, ends exclusive. Matches of one kind do not overlap; a term
that overlaps a base span is left to it. Null and empty texts have no spans. The
spans depend on the text alone, so repeated rows get equal ones, and null ids are
kept. An empty table gives an empty result. Columns other than the text are
passed through or not read.

DataFrame functions only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.frames import written
from ledgerloom.llm.sieve import sieve
from ledgerloom.llm.spans import let, located, replaced, running_most

KINDS = ("email", "ip", "card", "phone")
TERM = "term"

# The patterns of the kinds with possessive repeats, and with starts only where a run of
# the first characters begins (or the last match ended): the same matches, found
# in time linear in the text and without recursion.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WORD = r"(?<![\p{L}\p{N}_.@%+-])\p{L}{3,}+(?![\p{N}_@]|[.-][\p{L}\p{N}])"
TERMS = "array<struct<start:int,end:int,remove:boolean>>"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def holds(kind: str, value: Column) -> Column:
    """Whether a match is of its kind."""
    if kind == "ip":
        parts = F.split(value, r"\.")
        return F.forall(parts, lambda p: F.coalesce(p.try_cast("int"), F.lit(256)) <= 255)
    if kind == "card":
        size = F.length(digits(value))
        return size.between(14, 19) & F.call_function("luhn_check", digits(value))
    if kind == "phone":
        return F.length(digits(value)).between(10, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Array of (start, rank, end, kind, value), by start, then as the kinds are listed."""
    def of(rank: int, kind: str) -> Column:
        valid = F.filter(located(text, PATTERNS[kind]), lambda m: holds(kind, m["value"]))
        return F.transform(valid, lambda m: F.struct(
            m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"),
            F.lit(kind).alias("kind"), m["value"].alias("value")))

    return F.array_sort(F.concat(*[of(rank, kind) for rank, kind in enumerate(KINDS)]))


def entities(spans: Column) -> Column:
    """The distinct protected values of a text, however they are written, and their shared parts."""
    def of(s: Column) -> Column:
        kind, value = s["kind"], s["value"]
        whole = F.when(kind == "email", F.lower(value)).when(kind == "ip", value).otherwise(digits(value))
        part = (F.when(kind == "email", F.concat(F.lit("@"), F.substring_index(F.lower(value), "@", -1)))
                .when(kind == "ip", F.concat(F.substring_index(value, ".", 2), F.lit(".*")))
                .otherwise(F.concat(F.substring(digits(value), 1, 6), F.lit("*"))))
        return F.array(F.concat_ws(":", kind, whole), F.concat_ws(":", kind, part))

    return F.array_distinct(F.flatten(F.transform(spans, of)))


@dataclass(frozen=True)
class Findings:
    """``base``: the columns asked for, ``copy`` and ``spans`` of every row.
    ``terms``: ``copy, terms`` (start, end, action) of texts with revealing terms."""
    base: DataFrame
    terms: DataFrame


def words_of(text: Column) -> Column:
    """The distinct words of a text that may be terms, lower-cased."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(WORD), 0), F.lower))


def address(text: Column) -> Column:
    """What equal texts have in common: 16 bytes."""
    return F.unhex(F.md5(text))


def classes(rows: DataFrame, name: str, count: str, support: int) -> DataFrame:
    """``name``, the number of texts that have it, and a class: equal where those texts are the same.

    All addresses of a list that stands in two texts are one class, and so are all its
    words that stand nowhere else; pairs are counted between classes.
    """
    marks = [F.bit_xor(F.xxhash64(F.lit(k), "copy")).alias(f"mark{k}") for k in (0, 1)]
    return (rows.groupBy(name).agg(F.count("*").alias(count), *marks).where(F.col(count) >= support)
            .select(name, count, F.struct(F.col(count), "mark0", "mark1").alias("class")))


def rare_terms(said: DataFrame, likely: DataFrame, words: int = 4) -> DataFrame:
    """``term`` of the ``likely`` ones (with ``most``) that may be in at most ``most`` texts.

    Every text sets one of 64 * ``words`` bits of its terms. A term is in as many texts as it has
    bits set, or in more, so none is lost. Tasks set the bits of all words before anything is
    shuffled or joined, one row a term however often it stands.
    """
    bit = F.pmod(F.xxhash64("copy"), F.lit(64 * words))
    marks = [F.bit_or(F.when(F.floor(bit / 64) == k, F.call_function(
        "shiftleft", F.lit(1).cast("bigint"), F.pmod(bit, F.lit(64)).cast("int"))).otherwise(F.lit(0).cast("bigint")))
        .alias(f"bits{k}") for k in range(words)]
    found = sum((F.bit_count(f"bits{k}") for k in range(words)), F.lit(0))
    said = said.where(sieve(likely, "term", "pii-sieve-likely").may_hold(F.col("term")))
    return (said.groupBy("term").agg(*marks).join(likely.select("term", "most"), "term")
            .where(found <= F.col("most")).select("term"))


def revealing_terms(mentions: DataFrame, texts: DataFrame, total: int, support: int, firm: int,
                    smoothing: float, generalise_at: float, remove_at: float) -> tuple[DataFrame, DataFrame]:
    """``term, remove`` of the terms that reveal an entity, and ``copy, term`` of all texts that have one.

    ``mentions``: ``copy, entities, words`` of each text with an entity; ``texts``: ``copy, text`` of
    all rows. Words of all texts are only held against the terms that can still pass: tasks sieve
    out all others before a word is shuffled, however many terms there are.
    """
    held = mentions.select("copy", F.explode("entities").alias("entity"))
    known = written(classes(held, "entity", "n_entity", support), "pii-entities")
    said = mentions.select("copy", F.explode("words").alias("term"))
    seen = written(classes(said, "term", "n_seen", support), "pii-seen")
    needed = math.log2(max(1, known.count())) + math.log2(max(1, seen.count()))
    information = F.log2(F.lit(float(total)) / F.col("n_entity"))

    def most_texts(n_both: str) -> Column:
        return F.col(n_both) * F.pow(F.lit(float(total)) / F.col("n_entity"), F.lit(1 - generalise_at)) * 1.000001

    def can_pass(n_both: str) -> Column:
        """Texts with the term and any mention are no more than all that have the term."""
        return (F.col("n_seen") <= most_texts(n_both)) & (F.col(n_both) * information >= needed)

    # Entities that can be told apart at all, the texts that have one, and the terms that are in few
    # enough texts for the most frequent of them: all other words are sieved out before the join.
    strong = written(held.join(known.where(F.col("n_entity") * information >= needed), "entity")
                     .select("copy", "n_entity", F.col("class").alias("entities")).distinct(), "pii-strong")
    bound = strong.agg(F.max(most_texts("n_entity"))).first()[0] or 0.0
    few = written(seen.where(F.col("n_seen") <= bound), "pii-few")
    near = (mentions.where(sieve(strong, "copy", "pii-sieve-strong").may_hold(F.col("copy")))
            .select("copy", F.explode("words").alias("term"))
            .where(sieve(few, "term", "pii-sieve-few").may_hold(F.col("term"))))
    # By text once, for the distinct classes and for the join.
    words_in_text = (near.join(few, "term").select("copy", "n_seen", F.col("class").alias("terms"))
                     .repartition("copy").distinct())
    pairs = written(
        strong.join(words_in_text, "copy").where(can_pass("n_entity"))
        .groupBy("entities", "n_entity", "terms", "n_seen").agg(F.count("*").alias("n_both"))
        .where((F.col("n_both") >= support) & can_pass("n_both")), "pii-pairs")
    # The most texts a term may be in, by the best of its pairs.
    least = F.lit(total * 1.000001) / F.pow(F.lit(float(total)) / F.col("n_entity"), F.lit(generalise_at))
    most = pairs.groupBy(F.col("terms").alias("class")).agg(
        F.max(F.col("n_both") / F.col("n_entity") * least).alias("most"))
    likely = written(seen.join(most, "class").select("term", "class", "most"), "pii-likely")
    said = texts.select("copy", F.explode(words_of(F.col("text"))).alias("term"))
    rare = written(rare_terms(said, likely), "pii-rare")
    may_be_rare = said.where(sieve(rare, "term", "pii-sieve-rare").may_hold(F.col("term"))).distinct()
    hits = written(may_be_rare.join(rare, "term"), "pii-hits")
    counts = hits.groupBy("term").agg(F.count("*").alias("n_term"))
    added = F.when(F.col("n_both") < firm, F.lit(smoothing)).otherwise(0.0)
    pmi = F.log2(F.lit(float(total)) * F.col("n_both") / ((F.col("n_entity") + added) * (F.col("n_term") + added)))
    scored = (likely.join(counts, "term").join(pairs.withColumnRenamed("terms", "class"), "class")
              .withColumn("pmi", pmi).withColumn("ratio", F.when(information > 0, F.col("pmi") / information))
              .where((F.col("ratio") >= generalise_at) & (F.col("n_both") * F.col("pmi") >= needed)))
    return written(scored.groupBy("term").agg(F.max(F.col("ratio") >= remove_at).alias("remove")),
                   "pii-revealing"), hits


def one_of_each(rows: DataFrame) -> DataFrame:
    """One row of each ``copy``; only rows of a text that stands in several are shuffled."""
    repeated = written(rows.groupBy("copy").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("copy"),
                       "pii-repeated")
    may_repeat = sieve(repeated, "copy", "pii-sieve-repeated").may_hold(F.col("copy"))
    return rows.where(~may_repeat).unionByName(rows.where(may_repeat).dropDuplicates(["copy"]))


def find(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = (), support: int = 2, firm: int = 3,
         smoothing: float = 0.5, generalise_at: float = 0.9, remove_at: float = 0.97) -> Findings:
    """Base spans of every row, and the revealing terms of every text."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    texts = docs.select(address(text).alias("copy"), text.alias("text"))
    scanned = (docs.select(*[F.col(f"`{c}`").alias(f"keep_{c}") for c in keep], text.alias("text"))
               .withColumn("copy", address(F.col("text"))).withColumn("spans", base_spans(F.col("text"))))
    beside = F.when(F.size("spans") > 0, words_of(F.col("text"))).otherwise(F.array().cast("array<string>"))
    base = written(scanned.withColumn("entities", entities(F.col("spans"))).withColumn("words", beside)
                   .drop("text"), "pii")
    mentions = written(one_of_each(base.where(F.size("entities") > 0).select("copy", "entities", "words")),
                       "pii-mentions")
    total = max(1, base.select("copy").distinct().count())
    revealing, hits = revealing_terms(mentions, texts, total, support, firm, smoothing, generalise_at, remove_at)

    # A term that reveals an entity goes wherever it stands, beside the entity or not. One text of
    # each copy is searched; texts without such terms are sieved out before they are shuffled.
    searched = written(hits.join(revealing, "term", "left_semi").select("copy").distinct(), "pii-searched")
    firsts = (texts.where(sieve(searched, "copy", "pii-sieve-searched").may_hold(F.col("copy")))
              .groupBy("copy").agg(F.min("text").alias("text")))
    words = (firsts.join(searched, "copy", "left_semi")
             .select("copy", F.inline(free_words(F.col("text"))))
             .select("copy", "start", "end", F.lower("value").alias("term")))
    terms = words.join(revealing, "term").groupBy("copy").agg(
        F.array_sort(F.collect_list(F.struct("start", "end", "remove"))).alias("terms"))
    return Findings(base, written(terms, "pii-term-spans"))


def free_words(text: Column) -> Column:
    """Array of (start, end, value) of the words that overlap no base span."""
    def events(x: Column) -> Column:
        spans = F.transform(x["spans"], lambda s: F.struct(
            s["start"].alias("at"), F.lit(0).alias("is_word"), s["start"], s["end"], F.lit("").alias("value")))
        words = F.transform(x["words"], lambda w: F.struct(
            (w["end"] - 1).alias("at"), F.lit(1).alias("is_word"), w["start"], w["end"], w["value"]))
        return F.array_sort(F.concat(spans, words))

    def clear(x: Column) -> Column:
        """A word is free if all spans that begin before its end have ended at its start."""
        reached = running_most(F.transform(x, lambda e: F.when(e["is_word"] == 0, e["end"]).otherwise(0)))
        both = F.zip_with(x, reached, lambda e, r: F.struct(e.alias("e"), r.alias("reached")))
        free = F.filter(both, lambda b: (b["e"]["is_word"] == 1) & (b["reached"] <= b["e"]["start"]))
        return F.transform(free, lambda b: F.struct(b["e"]["start"], b["e"]["end"], b["e"]["value"]))

    found = F.struct(base_spans(text).alias("spans"), located(text, WORD).alias("words"))
    return let(let(found, events), clear)


def all_spans(found: Findings, salts: int = 16) -> DataFrame:
    """The kept columns of every row, with ``spans`` and ``terms``.

    Only rows that a sieve of the texts with terms lets through are joined to them. These
    are dealt by text and one of ``salts`` numbers, as a third of all rows may be copies of
    one text.
    """
    terms = found.terms.select("copy", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), "terms")
    rows = found.base.drop("entities", "words")
    none = F.array().cast(TERMS)
    may_hold = sieve(found.terms, "copy", "pii-sieve-terms").may_hold(F.col("copy"))
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")
    joined = (rows.where(may_hold).withColumn("salt", salt).join(terms, ["copy", "salt"], "left").drop("copy", "salt")
              .withColumn("terms", F.coalesce("terms", none)))
    return joined.unionByName(rows.where(~may_hold).drop("copy").withColumn("terms", none))


def with_terms(spans: Column, terms: Column) -> Column:
    """Base spans and terms in one array of (start, rank, end, kind, value)."""
    extra = F.transform(terms, lambda t: F.struct(
        t["start"].alias("start"), F.lit(len(KINDS)).alias("rank"), t["end"].alias("end"),
        F.lit(TERM).alias("kind"), F.when(t["remove"], "").otherwise("<TERM>").alias("value")))
    return F.array_sort(F.concat(spans, extra))


def redact(text: Column, spans: Column) -> Column:
    """The text with each base span replaced by its kind's name, each term by its ``value``.

    Spans that overlap are replaced together, under the name of the first.
    """
    return replaced(text, spans, lambda s: F.when(s["kind"] == TERM, s["value"]).otherwise(
        F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">"))))


def sanitise(docs: DataFrame, text_col: str = "text", **settings) -> DataFrame:
    """``docs`` with personal data and revealing terms taken out of the text (null stays null)."""
    found = all_spans(find(docs, text_col, keep=tuple(docs.columns), **settings))
    text = F.col(f"`keep_{text_col}`")
    safe = redact(text, with_terms(F.col("spans"), F.col("terms")))
    return found.select(*[(safe if c == text_col else F.col(f"`keep_{c}`")).alias(c) for c in docs.columns])
