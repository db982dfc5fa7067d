"""SimHash, decontamination and personal data against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerloom.llm import decontaminate, personal_data, simhash
from ledgerloom.llm.frames import written
from ledgerloom.llm.sieve import MOST_BITS, sieve

DOCS = "doc_id bigint, text string, copy string, id int, spans int, part int"


def documents(spark, texts):
    """Rows with extra columns whose names the operators use themselves."""
    return spark.createDataFrame(
        [(i, t, "x", 1, 2, 3) for i, t in texts], DOCS)


def near_texts(seed=1, families=12):
    rng = random.Random(seed)
    words = [f"w{k}é" for k in range(400)]
    out = []
    for _ in range(families):
        base = [rng.choice(words) for _ in range(rng.randint(30, 200))]
        for _ in range(rng.randint(1, 8)):
            copy = list(base)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append(" ".join(copy))
    return out + [None, "", "  \n", "one", "one two", "ONE two", "a b c", "x " * 30_000]


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps, ids, limit=3):
    root = list(range(len(fps)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= limit:
                root[find(a)] = find(b)
    least = {}
    for k, i in enumerate(ids):
        least[find(k)] = min(i, least.get(find(k), i))
    return [least[find(k)] for k in range(len(fps))]


def test_components_equal_brute_force(spark):
    texts = list(enumerate(near_texts()))
    texts += [(5, texts[5][1]), (900, texts[7][1])]  # a repeated row, a copy
    got = simhash.near_duplicates(documents(spark, texts)).rows.collect()
    fps = [slow_fingerprint(t) for _, t in texts]
    want = slow_components(fps, [i for i, _ in texts])
    as_bigint = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    assert sorted((r.id, r.fp, r.component) for r in got) == sorted(
        zip([i for i, _ in texts], as_bigint, want))


@pytest.mark.parametrize("unit", [8, 4096])
def test_links_of_dense_fingerprints(spark, unit):
    """Fingerprints a few bits apart: every component whole, however a hot key is cut."""
    rng = random.Random(3)
    base = rng.getrandbits(64)
    fps = sorted({base ^ sum(1 << b for b in rng.sample(range(20), rng.randint(0, 6))) for _ in range(120)}
                 | {rng.getrandbits(64) for _ in range(60)})
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    classes = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    n, both = simhash.bit_counts(classes)
    parts = simhash.plan_parts(n, both)
    edges = simhash.links(classes, parts, 3, unit)
    got = {r.node: r.label for r in simhash.components(edges).collect()}
    want = dict(zip(signed, slow_components(fps, signed)))
    assert {x: got.get(x, x) for x in signed} == want


@pytest.mark.parametrize("parts", range(1, 7))
def test_every_allocation_covers_the_limit(parts):
    """The thresholds add up to limit + 1 over disjoint bits, so no link is missed."""
    rng = np.random.default_rng(parts)
    bits = (rng.random((500, 64)) < rng.random(64)).astype(float)
    plan = simhash.plan_parts(500, bits.T @ bits, max_parts=parts)
    assert sum(p.flips + 1 for p in plan) == 4
    used = [b for p in plan for b in p.bits]
    assert len(used) == len(set(used))


def test_one_of_each_group_stays(spark):
    texts = [(3, "a b c d"), (1, "a b c d"), (1, "a b c d"), (2, "e f g h i"), (None, "q r s t u v")]
    kept = simhash.keep_one(documents(spark, texts))
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [1, 2, None]
    assert kept.columns == ["doc_id", "text", "copy", "id", "spans", "part"]


def test_an_id_held_by_different_texts(spark):
    texts = [(3, "a b c d"), (5, "a b c d"), (5, "e f g h i"), (5, "e f g h i"), (7, "a b c d"), (7, "e f g h i")]
    kept = simhash.keep_one(documents(spark, texts))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(3, "a b c d"), (5, "e f g h i")]


def test_no_rows(spark):
    empty = documents(spark, [])
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id int, text string")
    assert simhash.near_duplicates(empty).rows.count() == 0
    assert decontaminate.contamination(empty, items).count() == 0
    assert decontaminate.contamination(documents(spark, [(1, "a b")]), items.limit(0)).count() == 0
    assert personal_data.sanitise(empty).count() == 0


def test_items_inside_long_documents(spark):
    rng = random.Random(9)
    words = [f"v{k}" for k in range(3000)]
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.choice([1, 3, 6, 20, 60, 200]))))
             for k in range(40)] + [(98, None), (99, " ...")]
    items += [(100, items[5][1]), (5, items[5][1])]
    items += [(60, "rep " * 200), (61, "p q r s t u v " * 40), (62, "l1 l2 l3 " + "far " * 200 + "l4 l5 l6")]
    docs = []
    for k in range(60):
        text = [rng.choice(words) for _ in range(rng.randint(0, 900))]
        for _ in range(rng.randint(0, 3)):
            at, part = rng.randint(0, len(text)), items[rng.randrange(40)][1].split()
            if len(part) > 40 and rng.random() < 0.5:
                part = part[:int(len(part) * 0.9)]
            text[at:at] = [w.upper() + "," for w in part]
        docs.append((k, "\n".join(text)))
    docs += [(200, None), (201, ""), (0, docs[0][1])]
    for k, part in enumerate(["rep " * 30, "rep " * 2_000, "p q r s t u v " * 3, "far " * 300, items[-1][1],
                              items[-1][1][:-9], "p q r s t u"]):
        around = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 700))) for _ in range(2)]
        docs.append((210 + k, f"{around[0]} {part} {around[1]}"))
    got = decontaminate.contamination(
        documents(spark, docs), spark.createDataFrame(items, "item_id int, text string"),
        block_chars=6000)
    got = sorted((r.id, r.item, round(r.containment, 9)) for r in got.collect())
    want = []
    for i, text in docs:
        found = decontaminate.WORD.findall((text or "").lower())
        for item, own in sorted(set(items), key=repr):
            own = decontaminate.WORD.findall((own or "").lower())
            if not own:
                continue
            size = min(5, len(own))
            have = {tuple(found[k:k + size]) for k in range(len(found) - size + 1)}
            target = {tuple(own[k:k + size]) for k in range(len(own) - size + 1)}
            best = len(target & have) / len(target)
            if best >= 0.8:
                want.append((i, item, round(best, 9)))
    assert got == sorted(want)
    left = decontaminate.drop_contaminated(documents(spark, docs), spark.createDataFrame(
        items, "item_id int, text string"))
    assert sorted(r.doc_id for r in left.collect()) == sorted(
        i for i, _ in docs if i not in {w[0] for w in want})


PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
            ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"),
            ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def slow_valid(kind, match):
    plain = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "phone":
        return 10 <= len(plain) <= 15
    if kind == "card":
        doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(plain))]
        return 14 <= len(plain) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return True


def slow_spans(text):
    return sorted((m.start(), r, m.end(), k) for r, (k, p) in enumerate(PATTERNS)
                  for m in re.finditer(p, text or "") if slow_valid(k, m.group()))


def test_base_spans_equal_the_patterns(spark):
    rng = random.Random(4)
    pieces = ["a.b@c.d", "x_y@z", "@", ".", "-", " ", "+", "1", "25", "256", "999", "0", "é", "😀", "\n",
              "192.168.0.1", "4111 1111 1111 1111", "4111111111111111", "+1 (555) 010-9999", "a", "_", "("]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 60))) for _ in range(600)]
    texts += [None, "", "1" * 50_000, "a." * 30_000, "1 " * 40_000, "x@y.z " * 300]
    found = personal_data.find(documents(spark, list(enumerate(texts))), keep=("doc_id",))
    got = {r.keep_doc_id: r.s for r in found.base.selectExpr(
        "keep_doc_id", "transform(spans, s -> struct(s.start, s.rank, s.end, s.kind)) s").collect()}
    for k, text in enumerate(texts):
        assert [tuple(s) for s in got[k]] == slow_spans(text), text


def test_terms_that_reveal_are_taken_out(spark):
    """"Zanzibar" stands only beside one address, "house" everywhere."""
    texts = [(k, f"note {k}: the house Zanzibar bob@corp.example and more{k} words") for k in range(4)]
    texts += [(10 + k, f"the house and more words number {k} of them") for k in range(60)]
    texts += [(100, texts[0][1]), (101, None)]
    safe = {r.doc_id: r.text for r in personal_data.sanitise(documents(spark, texts)).collect()}
    assert "Zanzibar" not in safe[0] and "bob@" not in safe[0] and "<EMAIL>" in safe[0]
    assert "house" in safe[0] and safe[100] == safe[0] and safe[101] is None
    assert safe[12] == texts[6][1]


def test_a_revealing_term_goes_wherever_it_stands(spark):
    """Far from the address, at the very end of a text, and in a text without the address."""
    far = " the house" * 30
    texts = [(k, f"the house Zanzibar bob@corp.example{far} Zanzibar and{far} Timbuktu{far} more{k}") for k in range(4)]
    texts += [(4, "the house bob@corp.example Timbuktu"), (5, f"{far} zanzibar")]
    texts += [(10 + k, f"the house and more words number {k} of them") for k in range(60)]
    safe = {r.doc_id: r.text for r in personal_data.sanitise(documents(spark, texts)).collect()}
    assert not [t for t in safe.values() if "zanzibar" in t.lower() or "Timbuktu" in t]
    assert safe[0].count("the house") == 91 and safe[12] == texts[8][1]
    assert safe[5].startswith(far)


def test_terms_of_values_named_once_or_twice(spark):
    """One text is no evidence, two are in a large corpus; values of one domain are taken together."""
    texts = [(0, "the house Zanzibar amy@one.example"), (1, "the house Timbuktu +1 (555) 010-9999"),
             (2, "the house, Timbuktu, +15550109999"), (3, "the house 4111 1111 1111 1111 and Lima"), (4, "the Lima house"),
             (5, "Lima and the house"), (6, "in Lima they house the others"),
             (7, "the house Oslo ann@two.example"), (8, "Oslo is the house of bob@two.example")]
    texts += [(10 + k, f"the house and more words number {k} of them") for k in range(5_000)]
    safe = {r.doc_id: r.text for r in personal_data.sanitise(documents(spark, texts)).collect()}
    assert [safe[k] for k in (0, 1, 2)] == [
        "the house Zanzibar <EMAIL>", "the house <TERM> <PHONE>", "the house, <TERM>, <PHONE>"]
    assert safe[3] == "the house <CARD> and Lima" and all(safe[k] == t for k, t in texts[4:7])
    assert safe[7] == "the house <TERM> <EMAIL>" and safe[8] == "<TERM> is the house of <EMAIL>"
    few = {r.doc_id: r.text for r in personal_data.sanitise(documents(spark, texts[:60])).collect()}
    assert few[1] == "the house Timbuktu <PHONE>"


def slow_entities(text):
    out = set()
    for start, _, end, kind in slow_spans(text):
        value = text[start:end]
        plain = re.sub("[^0-9]", "", value)
        whole, part = {"email": (value.lower(), "@" + value.lower().rsplit("@")[-1]),
                       "ip": (value, ".".join(value.split(".")[:2]) + ".*")}.get(kind, (plain, plain[:6] + "*"))
        out |= {f"{kind}:{whole}", f"{kind}:{part}"}
    return out


def slow_terms(texts):
    """Revealing terms by counting every pair of an entity and a word."""
    word = re.compile(r"(?<![^\W_])(?<![_.@%+-])[^\W\d_]{3,}(?![^\W]|@|[.-][^\W_])")
    texts = sorted({t or "" for t in texts})
    of = [(slow_entities(t), {w.lower() for w in word.findall(t)}) for t in texts]
    n_entity = {e: n for e, n in Counter(e for es, _ in of for e in es).items() if n >= 2}
    n_seen = {w: n for w, n in Counter(w for es, ws in of if es for w in ws).items() if n >= 2}
    n_term = Counter(w for _, ws in of for w in ws)
    n_both = Counter((e, w) for es, ws in of for e in es & n_entity.keys() for w in ws & n_seen.keys())
    needed = math.log2(max(1, len(n_entity))) + math.log2(max(1, len(n_seen)))
    found = {}
    for (e, w), both in n_both.items():
        added = 0.5 if both < 3 else 0
        information = math.log2(len(texts) / n_entity[e])
        pmi = math.log2(len(texts) * both / ((n_entity[e] + added) * (n_term[w] + added)))
        if both >= 2 and information > 0 and pmi / information >= 0.9 and both * pmi >= needed:
            found[w] = found.get(w, False) or pmi / information >= 0.97
    return found


def test_terms_equal_brute_force(spark):
    rng = random.Random(11)
    common = [f"{a}{b}word" for a in "abcdefgh" for b in "abcdefgh"]
    rare = [f"{a}{b}{c}rare" for a in "klmno" for b in "klmno" for c in "klmno"]
    people = [(f"{w}@d{k % 7}.example", rng.sample(rare, 2)) for k, w in enumerate(common[:30])]
    people += [(f"10.{k}.3.{k}", rng.sample(rare, 2)) for k in range(8)] + [("+1 555 0100 99%02d" % k, rng.sample(rare, 1)) for k in range(8)]
    texts = []
    for k in range(500):
        words = [rng.choice(common) for _ in range(rng.randint(3, 20))]
        if rng.random() < 0.4:
            value, own = rng.choice(people)
            words += [value, *(w.upper() if rng.random() < 0.3 else w for w in own)]
        elif rng.random() < 0.2:
            words.append(rng.choice(rare))
        rng.shuffle(words)
        texts.append(" ".join(words))
    texts += texts[:40] + [None, ""]
    found = personal_data.find(documents(spark, list(enumerate(texts))), keep=("doc_id",))
    want = slow_terms(texts)
    assert len(want) > 5 and len(set(want.values())) == 2
    rows = personal_data.all_spans(found).collect()
    assert len(rows) == len(texts)
    for row in rows:
        text = texts[row.keep_doc_id] or ""
        places = [(m.start(), m.end(), want[m.group().lower()]) for m in re.finditer(r"[^\W\d_]+", text)
                  if m.group().lower() in want]
        assert [tuple(t) for t in row.terms] == places, text


def test_a_list_in_two_texts_is_one_class(spark):
    """Thousands of addresses beside thousands of words: neither time nor pairs grow with their product."""
    lines = " ".join(f"user{k}@host{k}.example {''.join(chr(97 + int(c)) for c in f'{k:05d}')}" for k in range(3_000))
    docs = documents(spark, [(1, lines), (2, lines + " again"), (3, "something else")])
    found = personal_data.find(docs, keep=("doc_id",))
    sizes = {r.keep_doc_id: (len(r.spans), len(r.terms)) for r in personal_data.all_spans(found).collect()}
    assert sizes[1][0] == sizes[2][0] == 3_000 and sizes[3] == (0, 0)


def test_functions_follow_the_containment_bound():
    """Items of very different sizes, whole or in two pieces, in documents of every length: recall."""
    rng = random.Random(13)
    items = [(k, [f"i{k}x{j}" for j in range(n)]) for k, n in enumerate([5, 6, 9, 13, 14, 20, 37, 60, 100, 250, 600] * 6)]
    index = decontaminate.build_index([(k, " ".join(words)) for k, words in items], 5, 0.8)
    assert sorted(len(c.ids) for c in index) == sorted(
        6 * n for n in Counter(1 << (max(0, len(w) - 4) - 1).bit_length() for _, w in items[:11]).values())
    texts, want = [], []
    for k, words in items:
        for pieces in (1, 2):
            cut = len(words) // 2 if pieces == 2 and len(words) > 50 else 0
            noise = [[f"n{rng.random()}" for _ in range(rng.choice([0, 10, 900, 5000]))] for _ in range(3)]
            texts.append(" ".join(noise[0] + words[:cut] + noise[1] + words[cut:] + noise[2]))
            want.append((len(texts) - 1, k))
    got = [(d, i) for d, i, _ in decontaminate.search(texts, index, 0.8, decontaminate.WordHash())]
    assert set(got) <= set(want) and len(set(got)) >= 0.99 * len(want) and len(got) == len(set(got))


@pytest.mark.parametrize("gap", [30, 400])
def test_an_item_held_in_two_parts(gap):
    """Containment is in the whole document, wherever the parts begin."""
    item = [f"i{k}" for k in range(68)]
    index = decontaminate.build_index([(1, " ".join(item))], 5, 0.8)
    texts = [" ".join([f"a{k}" for k in range(at)] + item[:34] + [f"b{k}" for k in range(gap)] + item[34:])
             for at in range(140)]
    got = list(decontaminate.search(texts, index, 0.8, decontaminate.WordHash()))
    assert got == [(k, 1, 60 / 64) for k in range(140)]


def test_a_sieve_loses_no_key(spark):
    rows = [(w,) for w in ["", "a", "ä", "\U0001f600", "x" * 50_000, None] + [f"w{k}" for k in range(3_000)]]
    keys = written(spark.createDataFrame(rows, "key string"), "keys")
    others = spark.range(20_000).select(F.concat(F.lit("other"), "id").alias("key"))
    for most_bits, by_chance in ((MOST_BITS, 200), (1 << 12, 20_000)):
        held = sieve(keys, "key", "held", most_bits)
        assert keys.where(held.may_hold(F.col("key"))).count() == len(rows)
        assert others.where(held.may_hold(F.col("key"))).count() <= by_chance


def test_a_sieve_without_keys_passes_none(spark):
    none = written(spark.createDataFrame([], "key string"), "none")
    assert spark.createDataFrame([("a",), (None,), ("",)], "key string").where(
        sieve(none, "key", "held").may_hold(F.col("key"))).count() == 0


def test_terms_do_not_depend_on_the_bits_of_a_sieve(spark, monkeypatch):
    texts = [f"mail ann@x{k % 40}.org about zephyr{chr(97 + k % 20)}qu and common words here" for k in range(400)]
    docs = documents(spark, list(enumerate(texts)))
    full = sorted(map(str, personal_data.sanitise(docs).collect()))
    monkeypatch.setattr(personal_data, "sieve", lambda keys, key, name: sieve(keys, key, name, 64))
    monkeypatch.setattr("ledgerloom.llm.sieve.LEAST_BITS", 64)
    assert sorted(map(str, personal_data.sanitise(docs).collect())) == full
