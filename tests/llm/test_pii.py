"""Personal data against brute force with Python's regular expressions."""

import hashlib
import random
import re

from strata.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute(text):
    out = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True,
                  "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                  "card": 12 <= len(digits) <= 19 and luhn(digits),
                  "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(out))


TEXTS = [
    None, "", "nothing here", "a@b.com", "x a@b.c.d@e.f y", "a@b.c_d@e.fg", "a@b.c.@d.e", "@a.b",
    "a@b", "a@b..c", "joe.%+-@x-y.z-w.co.", "..a@b.cd..", "é a@b.cd é 10.0.0.1 ü",
    "1.2.3.4.5.6.7.8", "256.1.1.1", "001.002.0003.4", "1.2.3", "0000000000255.1.1.1", "1.2.3.4.",
    "4111 1111 1111 1111", "4111-1111-1111-1111 4111  1111", "4111111111111112",
    "12 34", "0000 0000 0000", "x4111111111111111y", "4111 1111 1111 1111 2",
    "+1 (555) 555-5555", "+1 555", "+12345678901234567890", "+1 (555) 555-5555 (+44 20 7946 0958)",
    "++1 2345-678 9", "call +4420 79460958.", "9" * 70_000, "1 " * 40_000, "a" * 90_000 + "@b.cd",
    "a." * 30_000 + "x@" + "y." * 20_000 + "z", "1." * 30_000 + "1", " 41111111 a@bcd",
    "4111 1111 1111 1111" * 50, "+1 234 567 89" * 50, "é" * 1000 + " a@b.cd " * 700,
]


def test_base_spans_equal_brute_force(spark, docs_of):
    rng = random.Random(5)
    alphabet = "0123456789  --..@@++()abZ_%é\n\t"
    texts = TEXTS + ["".join(rng.choices(alphabet, k=rng.randint(1, 60))) for _ in range(1500)]
    got = {r["doc_id"]: r for r in pii.pii(spark, docs_of(list(enumerate(texts)))).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        expected = brute(text)
        assert got[i]["base"] == expected, (i, (text or "")[:80])
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [expected.count(f"{k}:") for k in pii.KINDS]
        assert set(filter(None, expected.split(","))) <= set(got[i]["spans"].split(","))


def test_context_discovers_unseen_identifiers(spark, docs_of):
    rows = [(i, f"please mail to user{i}@site{i}.org today") for i in range(30)]
    rows += [(100, "please mail to user77@intranet now"), (101, "please send to user78@intranet now"),
             (102, None), (103, "version 7 of 9")]
    got = {r["doc_id"]: r for r in pii.pii(spark, docs_of(rows)).collect()}
    assert got[100]["n_email"] == 0 and got[100]["spans"] == "email:15:30" and got[100]["n_added"] == 1
    assert got[101]["spans"] == "" and got[102]["spans"] == "" and got[103]["spans"] == ""
    assert got[3]["spans"] == got[3]["base"]


def test_a_context_of_mixed_kinds_vouches_for_nothing(spark, docs_of):
    rows = [(i, f"it is user{i}@site.org or") for i in range(10)]
    rows += [(50 + i, f"it is {i}.{i}.7.8 or") for i in range(10)] + [(99, "it is 12345 or")]
    got = {r["doc_id"]: r for r in pii.pii(spark, docs_of(rows)).collect()}
    assert got[99]["spans"] == ""


def test_contexts_reach_over_other_mentions_and_to_the_beginning(spark, docs_of):
    long = "x" * 90
    rows = [(i, f"Email: user{i}@site.org") for i in range(30)]
    rows += [(100 + i, f"reach u{i}@site.org\n v{i}@site.org w{i}@site.org") for i in range(30)]
    rows += [(200 + i, f"our order {i}, account a{i}@site.org") for i in range(30)]
    rows += [(300 + i, f"n{i}@site.org wrote") for i in range(30)]
    rows += [(400 + i, f"so y{long} is m{i}@site.org") for i in range(30)]
    rows += [(1000, "Email: joe@intranet"), (1001, "reach joe@in  ann@in sue@in"),
             (1002, "the order 12, account AB-x9"), (1003, "kim@intranet wrote"),
             (1004, f"so y{long} is joe@lan"), (1005, f"so z{long} is joe@far")]
    got = {r["doc_id"]: r["spans"] for r in pii.pii(spark, docs_of(rows)).collect()}
    assert got[1000] == "email:7:19"
    assert got[1001] == "email:6:12,email:14:20,email:21:27"
    assert got[1002] == "email:22:27"
    assert got[1003] == "email:0:12"
    assert got[1004] == f"email:{len(long) + 8}:{len(long) + 15}"
    assert got[1005] == ""


def test_discovered_identifiers_support_further_contexts(spark, docs_of):
    """The last identifier is reached in the fourth round, over two contexts that
    no base pattern matches in."""
    texts = [f"please mail to u{i}@site{i}.org" for i in range(2000)]
    texts += [f"please mail to d{i}@intra" for i in range(200)]
    texts += [f"kindly send for d{i}@intra" for i in range(200)]
    texts += [f"kindly send for e{i}@intra" for i in range(20)]
    texts += [f"notes kept by e{i}@intra" for i in range(20)]
    texts += ["notes kept by f@intra", "nothing known by f2@intra"]
    got = {r["doc_id"]: r["spans"] for r in pii.pii(spark, docs_of(list(enumerate(texts)))).collect()}
    assert got[2000] == "email:15:23" and got[2200] == "email:16:24" and got[2400] == "email:16:24"
    assert got[len(texts) - 2] == "email:14:21" and got[len(texts) - 1] == ""


def test_repeated_rows_and_empty_table(spark, docs_of):
    got = pii.pii(spark, docs_of([(1, "a@b.cd"), (1, "a@b.cd"), (None, "a@b.cd")])).collect()
    assert [r["base"] for r in got] == ["email:0:6"] * 3
    assert pii.pii(spark, docs_of([])).count() == 0


def test_query_digest(spark):
    from strata.llm.queries import op10_pii
    got = {r["doc_id"]: r for r in op10_pii(spark, "/root/testdata/sf0.001").collect()}
    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(got) == len(texts)
    for r in texts:
        assert got[r["doc_id"]]["base_sha256"] == hashlib.sha256(brute(r["text"]).encode()).hexdigest()


def plain_bootstrap(mentions):
    """The iteration on the pattern-instance graph in plain loops."""
    edge = {}
    for _, _, _, value, context, kind in mentions:
        held = edge.get((context, value))
        edge[context, value] = kind if held is None else held if kind is None else max(held, kind)
    seeds = {}
    for (_, value), kind in edge.items():
        if kind is not None:
            seeds[value] = (max(kind, seeds[value][0]) if value in seeds else kind, 1.0)
    known, found, last = dict(seeds), None, (0, 0, 0.0)
    while True:
        reliable = {}
        for context in {c for c, _ in edge}:
            own = [known.get(v) for c, v in edge if c == context]
            best = max(((sum(x[1] for x in own if x and x[0] == k), k, sum(1 for x in own if x and x[0] == k))
                        for k in {x[0] for x in own if x}), default=None)
            if best and best[2] >= pii.MIN_SEEDS and best[0] / (len(own) + 1) >= pii.MIN_CONTEXT:
                reliable[context] = best[1], best[0] / (len(own) + 1)
        doubt = {}
        for (context, value), kind in edge.items():
            if kind is None and context in reliable:
                k, trust = reliable[context]
                doubt[value, k] = doubt.get((value, k), 1.0) * (1 - trust)
        best = {}
        for (value, kind), x in doubt.items():
            if 1 - x >= pii.MIN_INSTANCE:
                kept = found is not None and value in found and found[value][0] == kind
                best[value] = max(best.get(value, (False, 0.0, "")), (kept, 1 - x, kind))
        found = {v: (kind, conf) for v, (_, conf, kind) in best.items()}
        known = {**found, **seeds}
        now = len(reliable), len(found), sum(c for _, c in found.values())
        if now[:2] == last[:2] and now[2] - last[2] < pii.SETTLED:
            break
        last = now
    return sorted((row, start, end, found[value][0]) for row, start, end, value, context, kind in mentions
                  if kind is None and value in found and reliable.get(context, (None,))[0] == found[value][0])


def test_added_spans_equal_brute_force(spark):
    """Random graphs of contexts and values, in which identifiers are found over several rounds."""
    rng = random.Random(17)
    added = 0
    for _ in range(6):
        kinds = {f"v{i}": rng.choice(["email", "phone", "ip"]) for i in range(120)}
        leaning = {f"c{i}": rng.choice(["email", "phone", "ip", None]) for i in range(10)}
        rows = []
        for i in range(1500):
            context = rng.choice(list(leaning))
            fit = [v for v, k in kinds.items() if leaning[context] in (None, k) or rng.random() < 0.002]
            value = rng.choice(fit)
            kind = kinds[value] if int(value[1:]) % 8 or rng.random() < 0.01 else None
            rows.append((i, 10 * i, 10 * i + 5, value, context, kind))
        df = spark.createDataFrame(rows, "row bigint, start int, end int, value string, context string, kind string")
        got = sorted(tuple(r) for r in pii.bootstrapped(spark, df.repartition(3)).collect())
        assert got == plain_bootstrap(rows)
        added += len(got)
    assert added > 100
