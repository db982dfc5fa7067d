"""Secret scans, source divergence and the filter audit against brute force."""

import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pandas as pd
import pytest

from ledgerloom.llm import divergence, interaction_audit, secret_scan
from ledgerloom.llm.spans import located, replaced
from ledgerloom.sources.snapshots import SnapshotTables

# --- secret scans -------------------------------------------------------------

ASSIGN = r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|""" \
    r"""[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = [("assign", ASSIGN, lambda m: len(m.group(1)) >= 6), ("access", r"AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 20),
         ("hex", r"[0-9a-f]+", lambda m: len(m.group()) >= 24)]


def slow_secrets(text):
    return sorted((m.start(), rank, m.end(), kind) for rank, (kind, pattern, good) in enumerate(KINDS)
                  for m in re.finditer(pattern, text or "") if good(m))


def odd_texts():
    rng = random.Random(12)
    pieces = ["password", "Passwd", "secret", "TOKEN", "api_key", "ApiKey", "=", ":", " ", "  ", '"', "'", "abcde", "abcdef",
              "AKIA", "AKIAABCDEFGH1234", "0123456789abcdef", "ABC", "é", "😀", "\n", "token:key", "/", ".", "g"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 40))) for _ in range(500)]
    return texts + [None, "", "f" * 60_000, "token=abc " * 4_000, "AKIA" * 9_000, "api_key" + " " * 30_000 + "= abcdefg"]


def test_secrets_equal_the_patterns(spark, tmp_path):
    texts = odd_texts()
    versions = spark.createDataFrame([(k, t, "x", "y", 1) for k, t in enumerate(texts)] + [(None, texts[3], "x", "y", 1)] * 2,
                                     "path int, text string, blob string, found string, salt int")
    ledger = secret_scan.BlobLedger(SnapshotTables(spark, str(tmp_path)))
    got = secret_scan.scan_versions(versions, ledger, keep=("path", "found", "salt")).toDF("path", "b", "s", "found").collect()
    assert len(got) == len(texts) + 2
    base = {rule.name for rule in secret_scan.BASE}
    for row in got:
        text = texts[3 if row.path is None else row.path]
        assert [tuple(s) for s in row.found if s["kind"] in base] == slow_secrets(text), text


def test_only_unseen_blobs_and_rules_are_scanned(spark, tmp_path):
    schema = "path string, commit int, text string"
    old = [("a", 1, "token = abcdefg"), ("b", 1, "nothing"), ("a", 2, "nothing"), ("c", 1, "AKIA" + "B" * 16)]
    ledger = secret_scan.BlobLedger(SnapshotTables(spark, str(tmp_path)))
    scans = lambda: ledger.tables.read(secret_scan.TABLE)
    first = secret_scan.scan_versions(spark.createDataFrame(old, schema), ledger, secret_scan.BASE, keep=("path", "commit"))
    assert {(r.path, r.commit): len(r.found) for r in first.collect()} == {
        ("a", 1): 1, ("b", 1): 0, ("a", 2): 0, ("c", 1): 1}
    assert scans().count() == 3 * 3  # three blobs, three rules

    more = spark.createDataFrame([*old, ("d", 1, "token = abcdefg"), ("a", 3, "new text")], schema)
    second = secret_scan.scan_versions(more, ledger, secret_scan.BASE, keep=("path", "commit"))
    assert {(r.path, r.commit) for r in second.collect() if r.found} == {("a", 1), ("c", 1), ("d", 1)}
    assert scans().count() == 4 * 3

    # A new version of one rule runs on all blobs, the others on none; its old findings no longer count.
    changed = [*secret_scan.BASE[:1], secret_scan.Rule("access", "AKIA[A-Z0-9]++", least=30, version=2), secret_scan.BASE[2]]
    third = secret_scan.scan_versions(more, ledger, changed, keep=("path", "commit"))
    assert {r.path for r in third.collect() if r.found} == {"a", "d"}
    assert scans().count() == 4 * 3 + 4 and scans().where("version = 2").count() == 4
    assert secret_scan.scan_versions(more.limit(0), ledger, changed, keep=("path",)).count() == 0


def test_further_rules(spark, tmp_path):
    texts = ["-----BEGIN RSA PRIVATE KEY-----\nMIIB/+=\nabc\n-----END RSA PRIVATE KEY-----", "ghp_" + "aZ" * 20,
             "postgres://bob:hunter22@db.example/x", "eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJSMeK", "http://example.org/a:b@c"]
    versions = spark.createDataFrame(list(enumerate(texts)), "path int, text string")
    ledger = secret_scan.BlobLedger(SnapshotTables(spark, str(tmp_path)))
    got = {r.path: [s["kind"] for s in r.found] for r in secret_scan.scan_versions(versions, ledger, keep=("path",)).collect()}
    assert got == {0: ["private_key"], 1: ["prefixed"], 2: ["url_password"], 3: ["jwt"], 4: []}


def test_places_in_texts_with_many_matches(spark):
    """Offsets and replacements equal Python's, also over the borders of blocks."""
    rng = random.Random(5)
    texts = ["".join(rng.choice(["x", "é", "😀", "77", " "]) for _ in range(n)) for n in (0, 1, 5, 2048, 2049, 9000)]
    texts += ["7" * 5000, "é" * 6000, "a7" * 20_000]
    frame = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    found = frame.select("k", "t", located(frame.t, "7+|x").alias("m"))
    rows = found.select("k", "m", replaced(found.t, found.m, lambda s: s["value"].substr(1, 1)).alias("r")).collect()
    for row in rows:
        want = [(m.start(), m.end(), m.group()) for m in re.finditer("7+|x", texts[row.k])]
        assert [tuple(m) for m in row.m] == want
        assert row.r == re.sub("7+|x", lambda m: m.group()[0], texts[row.k])


# --- source divergence --------------------------------------------------------

def slow_divergence(docs, support):
    docs = [(t or "", l or "", s or "") for _, t, l, s in docs]
    words = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t))
    out = []
    for lang in {d[1] for d in docs}:
        mine = [d for d in docs if d[1] == lang]
        held = Counter(w for t, _, _ in mine for w in set(words(t)))
        kept = [w for w, n in held.items() if n >= support]
        shares, counts = {}, {}
        for name in [None, *{s for _, _, s in mine}]:
            count = Counter(w for t, _, s in mine if name is None or s == name for w in words(t) if held[w] >= support)
            total = sum(count.values())
            counts[name] = count
            shares[name] = {w: 1 + 10**9 * (count[w] + 2) // (total + 2 * len(kept)) for w in kept}
        f = lambda p, q: (p - q) ** 2 // (p + q)
        for name in counts.keys() - {None}:
            peers = [(sum(f(shares[name][w], shares[o][w]) for w in kept), o) for o in counts.keys() - {None, name}]
            terms = [(f(shares[name][w], shares[None][w]), w) for w in counts[name]
                     if shares[name][w] > shares[None][w]]
            for part, rows in (("pair", peers), ("term", terms)):
                ranked = sorted(rows, key=lambda r: (-r[0], r[1].encode()))
                out += [(lang, name, part, item, value, k + 1) for k, (value, item) in enumerate(ranked)
                        if part == "pair" or k < 10]
    return sorted(out)


@pytest.mark.parametrize("block", [7, 200_000])
def test_divergence_equals_brute_force(spark, block):
    rng = random.Random(3)
    words = [f"w{a}" for a in "abcdefghijklmnopqrstuvwxyz"] + ["É", "漢字", "ﬀ"]
    docs = []
    for k in range(160):
        skewed = words[:rng.randint(1, len(words))]
        text = " ".join(rng.choice(skewed).upper() if rng.random() < 0.2 else rng.choice(skewed)
                        for _ in range(rng.randint(0, 40)))
        docs.append((k, text, rng.choice(["en", "fr", None]), rng.choice(["s1", "s2", "s3", "é", "", None, "s1"])))
    docs += [(1, docs[1][1], "en", "s1"), (None, None, "zz", "a"), (None, "", "zz", "b"), (9, "12 34", "en", "numbers")]
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id int, text string, lang string, source string, k int, term string")
    got = divergence.divergence(frame, support=4, block_postings=block)
    assert sorted(tuple(r) for r in got.collect()) == slow_divergence(docs, 4)
    assert divergence.divergence(frame.limit(0)).count() == 0


def test_counts_beyond_a_machine_word(spark):
    """A count of 10^11 times 10^9 needs more than 64 bits."""
    frame = spark.createDataFrame([(10**11, 3 * 10**11, 10**6)], "n bigint, t bigint, v bigint")
    got = frame.select(divergence.share(frame.n, frame.t, frame.v)).first()[0]
    assert got == 1 + 10**9 * (10**11 + 2) // (3 * 10**11 + 2 * 10**6)
    p = np.array([10**9 + 1, 1, 5], dtype=np.int64)
    assert divergence.differences(p, p[::-1].copy()).tolist() == [
        (a - b) ** 2 // (a + b) for a, b in zip(p.tolist(), p[::-1].tolist())]


# --- filter audit -------------------------------------------------------------

def slow_audit(docs, labels):
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    judged = []
    for i, t, part in docs:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
                 "E": i is not None and i > least[t]}
        judged.append((part or "", {x for x in fails if fails[x]}, i in good, i in toxic))
    out, removed_by = [], Counter()
    for part in {p for p, *_ in judged}:
        mine = [j for j in judged if j[0] == part]
        for order in map("".join, permutations("ABCDE")):
            for step, letter in enumerate(order):
                before = set(order[:step])
                gone = [j for j in mine if letter in j[1] and not j[1] & before]
                removed_by[part, letter] += len(gone)
                out.append([part, order, step + 1, sum(not j[1] & (before | {letter}) for j in mine), len(gone),
                            sum(letter in j[1] and bool(j[1] & before) for j in mine), sum(j[1] == {letter} for j in mine),
                            sum(j[2] for j in gone), sum(j[3] for j in gone)])
    return sorted((*row, removed_by[row[0], row[1][row[2] - 1]]) for row in out)


def audit_rows():
    rng = random.Random(7)
    words = [f"word{k}" for k in range(90)] + ["CAPITALS", "100%", "é😀"]
    texts = [" ".join(rng.choice(words[:rng.choice([5, 90, 93])]) for _ in range(rng.choice([0, 3, 49, 50, 51, 120])))
             for _ in range(60)] + [None, "", "a", "ab", "abc", "abd", "x " * 30_000, "x " * 30_000 + "y"]
    docs = [(rng.randint(0, 150), rng.choice(texts), rng.choice(["p", "q", "é", "", None])) for _ in range(300)]
    docs += [(None, texts[1], "p"), (None, texts[1], "p"), docs[0], docs[0]] + [(500 + k, texts[2], "hot") for k in range(150)]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1])) for k in range(150)] + [(3, 1, 1), (None, 1, 1), (510, 1, 0)]
    return docs, labels


@pytest.mark.parametrize("chars", [500, 32_000_000])
def test_audit_equals_brute_force(spark, chars):
    docs, labels = audit_rows()
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id bigint, text string, source string, mask int, part string")
    named = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = interaction_audit.audit(frame.repartition(3), named, range_chars=chars, trie_chars=chars, sample_chars=chars)
    columns = ["part", "filter_order", "step", *interaction_audit.COUNTS]
    assert sorted(tuple(r) for r in got.select(columns).collect()) == slow_audit(docs, labels)
    assert interaction_audit.audit(frame.limit(0), named).count() == 0


def test_trie_holds_whole_texts():
    rng = random.Random(1)
    texts = {"".join(rng.choice("ab") for _ in range(rng.randint(0, 9))) for _ in range(400)} | {"a" * 50_000, "a" * 49_999 + "b"}
    trie = interaction_audit.Trie()
    for text in sorted(texts, key=lambda t: rng.random()):
        node = trie.terminal(text)
        assert node.value is None
        node.value = text
    assert all(trie.terminal(t).value == t for t in texts)
    assert sorted(trie.terminals()) == sorted((t, t) for t in texts)
    rows = [(3, "p"), (2, "q"), (2, "p"), (9, "p"), (1, "p")]
    terminal = interaction_audit.Terminal(0)
    told = [x for i, p in rows for x in terminal.add(i, p, 1)]
    assert told == [(3, "p", 1), (9, "p", 1), (2, "q", 1), (2, "p", 1)] and terminal.rows == {"p": 1}


def test_borders_part_the_texts_evenly(spark):
    """Texts that share a long beginning are parted behind it."""
    texts = ["common beginning " * 60 + f"{k:05d} and more" for k in range(3000)]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    total = sum(map(len, texts))
    borders = interaction_audit.range_borders(frame, 8, total, total)
    sizes = np.bincount(np.searchsorted(np.array(borders), np.array(texts), side="right"))
    assert len(borders) >= 6 and sizes.max() < 2 * len(texts) / 7
    assert pd.Series(borders).str.len().max() < 60 * 17 + 6
