import hashlib
import re
from collections import Counter, defaultdict

import pytest

from tessera.llm import pii

# the patterns as the contract states them
BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
CUT = r"""\x00-\x20\x7F"'(),:;<=>\[\]{}|"""
SCHEMA = "doc_id long, text string, rid long, kind string, value string, l1 string"


def luhn(d):
    s = [int(c) for c in reversed(d)]
    return sum(s[0::2] + [sum(divmod(2 * x, 10)) for x in s[1::2]]) % 10 == 0


def base_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            v, d = m.group(), re.sub("[^0-9]", "", m.group())
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in v.split("."))
                    or kind == "card" and 12 <= len(d) <= 19 and luhn(d) or kind == "phone" and 9 <= len(d) <= 15):
                out.append((m.start(), k, m.end()))
    return sorted(out)


def units(text):
    low = "".join("0" if c in "0123456789" else c.lower() if c.isascii() else c for c in text)
    return [u for u in re.split(f"[{CUT}]+", low) if u]


def brute(texts):
    base = [base_spans(t) for t in texts]
    occ, places = [], Counter()
    for i, t in enumerate(texts):
        u = units(t)
        places.update(u)
        places.update(f"{a} {b}" for a, b in zip(u, u[1:]))
        found = [(a, b, t[a:b], True) for a, _, b in base[i]]
        for m in re.finditer(f"[^{CUT}]+", t):
            v = re.sub("[.!?]+$", "", m.group())
            a, b = m.start(), m.start() + len(v)
            if len(v) >= 6 and sum(c in "0123456789" for c in v) >= 3 and not any(x < b and a < y for x, _, y in base[i]):
                found.append((a, b, v, False))
        for a, b, v, seed in found:
            u = units(t[max(0, a - 160):a])
            occ.append((i, a, b, v, seed, u[-1:], [" ".join(u[-2:])] if len(u) > 1 else []))
    accepted = {o[3] for o in occ if o[4]} and set()
    for _ in range(3):
        n, values = Counter(), defaultdict(set)
        for _, _, _, v, seed, one, two in occ:
            if seed or v in accepted:
                for p in one + two:
                    n[p] += 1
                    values[p].add(v)
        good = {p for p in n if len(values[p]) >= 3 and 100 * n[p] >= 60 * places[p]}
        hits, all_ = Counter(), Counter()
        for _, _, _, v, seed, one, two in occ:
            if not seed and one:
                all_[v] += 1
                hits[v] += bool(good & set(one + two))
        accepted = {v for v in all_ if 2 * hits[v] >= all_[v]}
    ids = defaultdict(list)
    for i, a, b, v, seed, _, _ in occ:
        if not seed and v in accepted:
            ids[i].append((a, 4, b))
    name = list(BASE) + ["id"]
    text_of = lambda s: ",".join(f"{name[k]}:{a}:{b}" for a, k, b in sorted(s))
    return [(hashlib.sha256(text_of(base[i]).encode()).hexdigest(), text_of(base[i] + ids[i]),
             [sum(k == j for _, k, _ in base[i]) for j in range(4)]) for i in range(len(texts))]


def check(spark, rows):
    docs = spark.createDataFrame([(i, t, 1, "k", "v", "l") for i, t in rows], SCHEMA)
    found = pii.find(docs)
    from pyspark.sql import functions as F

    base = F.filter("spans", lambda s: s["kind"] < 4)
    got = sorted((str(r["doc_id"]), r["b"], r["s"]) for r in found.select(
        "doc_id", F.sha2(pii.span_list(base), 256).alias("b"), pii.span_list(F.col("spans")).alias("s")).collect())
    want = brute([t or "" for _, t in rows])
    assert got == sorted((str(i), b, s) for (i, _), (b, s, _) in zip(rows, want))
    return {str(i): s for i, (_, s, _) in zip([r[0] for r in rows], want)}


EDGES = [
    "a@b@c.d", "a@b.c_d@e.f", "x.y+z%@host-1.example.co.uk.", "@no.pe", "a@b", "..@a.b..c", "1.2.3.4.5.6.7.8", "256.1.1.1 001.002.003.255",
    "1.2.3 .4", "9999.1.1.1.1", "4539 1488 0343 6467", "4539-1488-0343-6467-", "45391488034364671", "4539  1488", "0" * 12, "1 2 3 4 5 6 7 8 9 0 1 2 8",
    "+1 (724) 555-7058", "+1-", "+12345678", "+1 23 45 67 89 01 23 45 6", "++49 30 1234567", "+1     ", "é\U0001f600 a@b.cd \U0001f600 10.0.0.1", "12a34b56 c",
    "+1 724 555 7058 4539148803436467", "a@1.2.3.4", "code=ab12345,code:(ab12345)", "ab1234.!? x", "12345", "123456", "x" * 70_000, "1" * 70_000, "a." * 40_000,
    "+1" + " " * 70_000, "a@" + "b." * 30_000 + "c", "1." * 30_000, "1 " * 30_000, "", None, "\x00\x01 a@b.c\n\tq@r.st",
]


def test_base_edges(spark):
    check(spark, [(i, t) for i, t in enumerate(EDGES)] + [(None, "a@b.c"), (0, "a@b.c"), (0, "a@b.c")])


CONTEXTS = ([(i, f"Lorem ipsum. Contact: user{i}@mail.example.org or see the number") for i in range(8)]
            + [(10 + i, f"contact: badge-77{i}x please") for i in range(4)]
            + [(20 + i, f"Staff pass badge-77{i}x;") for i in range(4)] + [(24, "(staff pass QX8812.)")]
            + [(30 + i, f"the {i}99000 of the number {i}5 and the 10.0.0.{i}") for i in range(6)]
            + [(40, "staff pass zz90909 only here"), (41, "the 1990-2000 years")])


def test_patterns_discover_identifiers(spark):
    """Seeds teach ``contact``, its badges teach ``staff pass``, which finds
    codes that no seed pattern describes; frequent words teach nothing."""
    got = check(spark, CONTEXTS)
    assert [k for k in got if "id:" in got[k]] == [str(i) for i in (10, 11, 12, 13, 20, 21, 22, 23, 24, 40)]
    assert got["24"] == "id:12:18" and got["41"] == ""


def test_hot_values_and_repeats(spark):
    check(spark, CONTEXTS + [(7, "contact: user1@mail.example.org contact: badge-771x")] * 60)


def test_empty_table(spark):
    assert pii.find(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("name", ["op12_pii"])
def test_query_against_brute_force(spark, name):
    from tessera.llm import queries
    from tests.conftest import SF_SMALL

    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = brute([r["text"] or "" for r in rows])
    got = sorted((r["doc_id"], r["base_sha256"], r["spans"], [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]])
                 for r in queries.QUERIES[name](spark, SF_SMALL).collect())
    assert got == sorted((r["doc_id"], *w) for r, w in zip(rows, want))
