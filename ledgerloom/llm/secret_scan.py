"""Secrets in every version of every file, scanned once for each blob and rule version.

A text's address is its SHA-256: versions, paths and copies with equal content are
one blob. The ledger is a table of (blob, rule, version, spans) in the shared folder,
one committed part for each scan, a row also where nothing was found. A scan lists the
blobs of the versions it is given, strikes out the (blob, rule version) pairs that the
ledger holds, scans what is left, one text for each blob, and appends. A rule that
is changed gets a new version number, and then only that rule runs on old blobs. At
last the findings of the rules asked for are joined back to all paths.

Spans are of code points, ends exclusive; matches of one kind do not overlap. Null texts are
empty and, as these, have no spans. Every row of the versions is returned, repeated
ones and those with null keys alike. An empty table gives an empty result. Columns
other than the text and those to keep are not read.

DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.frames import written
from ledgerloom.llm.spans import located
from ledgerloom.sources.snapshots import SnapshotTables


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has ``least`` code points or more; others are dropped."""
    name: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1


# The patterns of the base kinds, with possessive repeats where no other way to match
# is lost, and with starts only where a run begins: the same matches in linear time.
BASE = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)""",
         group=1, least=6),
    Rule("access", r"AKIA[A-Z0-9]++", least=20),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{24,}+"),
)
# Public formats of keys and tokens.
FURTHER = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----[A-Za-z0-9+/=\s]*+-----END [A-Z ]{0,24}PRIVATE KEY-----"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"),
    Rule("url_password", r"(?<![a-z0-9+.-])[a-z][a-z0-9+.-]{0,20}://[^\s:/@?#]{1,80}:[^\s:/@?#]{3,80}@"),
    Rule("prefixed", r"(?<![A-Za-z0-9])(?:gh[pousr]_[A-Za-z0-9]{36,}+|xox[abprs]-[A-Za-z0-9-]{20,}+|[sr]k_live_[A-Za-z0-9]{20,}+)"),
)
RULES = BASE + FURTHER
TABLE = "scans"
SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
SCAN = T.StructType([T.StructField("blob", T.BinaryType()), T.StructField("rule", T.StringType()),
                     T.StructField("version", T.IntegerType()), T.StructField("spans", SPANS)])


def address(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def matches(text: Column, rule: Rule) -> Column:
    """Array of (start, end) of a rule's matches."""
    found = located(text, rule.pattern)
    if rule.least > 1:
        size = lambda m: F.length(F.regexp_extract(m["value"], rule.pattern, rule.group))
        found = F.filter(found, lambda m: size(m) >= rule.least)
    return F.transform(found, lambda m: F.struct(m["start"], m["end"]))


class BlobLedger:
    """What has been scanned, and what was found, under a folder."""

    def __init__(self, tables: SnapshotTables):
        self.tables = tables

    def scans(self, rules: Sequence[Rule]) -> DataFrame:
        """The rows of these rules in their present versions."""
        if self.tables.current(TABLE) is None:
            return self.tables.spark.createDataFrame([], SCAN)
        present = [F.lit(f"{r.name}:{r.version}") for r in rules]
        return self.tables.read(TABLE, SCAN).where(F.concat_ws(":", "rule", "version").isin(*present))

    def unseen(self, blobs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
        """``blob, rules``: the rules that have yet to run on each of ``blobs``, none left out."""
        every = F.array(*[F.lit(r.name) for r in rules])
        if self.tables.current(TABLE) is None:
            return blobs.select("blob", every.alias("rules"))
        seen = self.scans(rules).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        none = F.array().cast("array<string>")
        return (blobs.join(seen, "blob", "left")
                .select("blob", F.array_except(every, F.coalesce("seen", none)).alias("rules"))
                .where(F.size("rules") > 0))

    def scan(self, texts: DataFrame, rules: Sequence[Rule]) -> None:
        """Scan what is unseen of ``blob, text`` rows and append it to the ledger.

        One text of each blob is kept before the texts are shuffled. Spark applies the
        list of unseen blobs before that where it is small enough to broadcast, and joins
        it to the shuffled texts, which are dealt by blob already, where it is not.
        """
        due = written(self.unseen(texts.select("blob").distinct(), rules), "unseen-blobs")
        firsts = texts.groupBy("blob").agg(F.min("text").alias("text"))
        todo = firsts.join(due.select("blob"), "blob", "left_semi").join(due, "blob")
        results = F.array(*[
            F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version"),
                     F.when(F.array_contains("rules", r.name), matches(F.col("text"), r)).alias("spans"))
            for r in rules])
        found = todo.select("blob", F.inline(results)).where(F.col("spans").isNotNull())
        self.tables.append(TABLE, found.select(*SCAN.names))

    def findings(self, rules: Sequence[Rule]) -> DataFrame:
        """``blob, found`` of blobs with secrets: (start, rank, end, kind) by start, then as rules are listed."""
        ranks = F.array(*[F.lit(r.name) for r in rules])
        rows = self.scans(rules).where(F.size("spans") > 0).select("blob", "rule", F.inline("spans"))
        span = F.struct("start", (F.array_position(ranks, F.col("rule")).cast("int") - 1).alias("rank"),
                        "end", F.col("rule").alias("kind"))
        return rows.groupBy("blob").agg(F.array_sort(F.collect_set(span)).alias("found"))


FOUND = "array<struct<start:int,rank:int,end:int,kind:string>>"


def scan_versions(versions: DataFrame, ledger: BlobLedger, rules: Sequence[Rule] = RULES,
                  text_col: str = "text", keep: Sequence[str] = (), salts: int = 16) -> DataFrame:
    """The columns in ``keep`` and ``found`` of every row; blobs new to the ledger are scanned first.

    The few blobs with findings are joined to the rows. Where they are too many to
    broadcast, rows are dealt by blob and one of ``salts`` numbers, as one blob may be that
    of a third of all rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    ledger.scan(versions.select(address(text).alias("blob"), text.alias("text")), rules)
    found = ledger.findings(rules).select(
        "blob", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), "found")
    rows = versions.select(*[F.col(c).alias(f"keep_{k}") for k, c in enumerate(keep)], address(text).alias("blob"),
                           F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int").alias("salt"))
    return rows.join(found, ["blob", "salt"], "left").select(
        *[F.col(f"keep_{k}").alias(c) for k, c in enumerate(keep)],
        F.coalesce("found", F.array().cast(FOUND)).alias("found"))
