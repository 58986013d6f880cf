from __future__ import annotations

import hashlib
import random
import re

from loadcast.llm import pii

RULES = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def base(text):
    out = []
    for kind, rule in RULES.items():
        for m in re.finditer(rule, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")) or kind == "card" and not (16 <= len(d) <= 19 and luhn(d)) \
                    or kind == "phone" and not 8 <= len(d) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def check(df, texts):
    got = {r.doc_id: r for r in pii.report(df).collect()}
    for i, t in texts.items():
        want = base(t)
        line = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert [got[i][f"n_{k}"] for k in RULES] == [sum(x[0] == k for x in want) for k in RULES], (i, t)
        assert got[i].base_sha256 == hashlib.sha256(line.encode()).hexdigest(), (i, t, got[i].spans, line)
        assert set(line.split(",")) - {""} <= set(got[i].spans.split(","))
    return got


def test_base_spans_match_the_rules(spark):
    rng = random.Random(9)
    bits = ["a@b.c", "a@b", "x.y+z%q_-@d-e.f.g", "@", ".", "..", "_", "1.2.3.4", "300.1.1.1", "1.2.3.4.5.6.7.8", "01.002.0.255", "+1 (555) 010-9999",
            "+12", "+", "4111111111111111", "4111 1111-1111 1111", "4111111111111112", "7", " ", "-", "é", "\U0001F600", "\n", "a1", "+49.30.1234567", "("]
    texts = {i: "".join(rng.choice(bits) + rng.choice(["", " ", "", "."]) for _ in range(rng.randrange(1, 25))) for i in range(400)}
    texts |= {900: None, 901: "", 902: "1 " * 30000, 903: "a." * 1500 + "@", 904: "9" * 100_000, 905: "a@b.c" * 2000, 906: "+1" * 20000, 907: "1-" * 40000 + "1", 908: "a" * 30_000, 909: "a." * 10_000, 910: "\u00e9" * 30_000 + " x@y.z"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").selectExpr("*", "1 as t", "2 as version", "3 as base", "4 as pattern")
    check(df.repartition(8), texts)
    assert pii.report(df.limit(0)).count() == 0


def test_patterns_find_unseen_identifiers(spark):
    rng = random.Random(1)
    rows = [(i, f"Some words here. Please contact person a{i}@mail.example.com for details, and so on. Version 3 of it.") for i in range(20)]
    rows += [(100, "Please contact person ZX81-4477-99 for details, no address."), (101, "Nothing about ZX81-4477-99 there."),
             (102, "Please contact person 3 for details.")]
    rows += [(200 + i, f"order number {rng.randrange(10**7, 10**8)} shipped") for i in range(20)]
    texts = dict(rows)
    got = check(spark.createDataFrame(rows + rows[:2], "doc_id long, text string"), texts)
    at = texts[100].index("ZX81")
    assert got[100].spans == f"id:{at}:{at + 12}"
    at = texts[101].index("ZX81")  # seen elsewhere in the context
    assert got[101].spans == f"id:{at}:{at + 12}"
    assert got[102].spans == "" == got[205].spans == ""


def test_seeds_without_digits_find_what_stands_in_their_slot(spark):
    names = ["ann", "bob", "cid", "dee", "eve", "flo", "gus", "hal", "ida", "jim", "kay", "lea"]
    long = "x" * 200
    rows = [(i, f"For questions write to {n}@example.org at any time. See also section three.") for i, n in enumerate(names)]
    rows += [(100, "For questions write to mona(at)example.org at any time."), (101, "We met mona(at)example.org, who said so."),
             (102, "For questions write to him at any time."), (103, "She read and/or wrote it. The file is a.b, or so.")]
    rows += [(200 + i, f"Then the account {long}{n} is of {n}.{n}@example.org now") for i, n in enumerate(names)]
    texts = dict(rows)
    got = check(spark.createDataFrame(rows, "doc_id long, text string"), texts)
    for d in (100, 101):
        at = texts[d].index("mona")
        assert got[d].spans == f"id:{at}:{at + 19}", d
    assert got[102].spans == got[103].spans == ""
