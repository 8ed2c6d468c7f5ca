import hashlib
import random
import re
import time

import numpy as np

from blockfuse.llm import pii

NAIVE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def naive(text):
    out = []
    for k, (kind, pattern) in enumerate(NAIVE.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda: 12 <= len(digits) <= 19 and sum(
                    int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(digits[::-1])
                ) % 10 == 0,
                "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]()
            if ok:
                out.append((m.start(), m.end(), k))
    return sorted(out, key=lambda s: (s[0], s[2]))


def test_base_spans_equal_the_plain_patterns():
    rnd = random.Random(1)
    pieces = ["a", "b.c", "@", "@", ".", "-", "_", "+", " ", "1", "22", "255", "4539578763621486", "é", "(", ")", "\n", "x@y.z", "1.2.3.4"]
    for _ in range(4000):
        text = "".join(rnd.choices(pieces, k=rnd.randint(0, 25)))
        assert pii.base_spans(text) == naive(text), text


def test_cards_and_phones_over_many_digits():
    rnd = random.Random(2)
    for _ in range(3000):
        text = "".join(rnd.choices("0123456789 -+.", weights=[9] * 10 + [4, 4, 2, 1], k=rnd.randint(10, 60)))
        assert pii.base_spans(text) == naive(text), text


def corpus(n=300):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choices("abcdefghij", k=rnd.randint(2, 8)))
    out = []
    for _ in range(n):
        w = [word() for _ in range(30)]
        number = f"{rnd.randint(200, 999)} 555-{rnd.randint(1000, 9999)}"
        w[5] = f"call +1 ({number[:3]}) {number[4:]}"
        w[15] = f"mail {word()}.{word()}@{word()}.com"
        w[20] = str(rnd.randint(0, 99))
        out.append(" ".join(w))
    return out


def test_field_adds_repeats_and_keeps_base_spans():
    field = pii.train(corpus())
    text = "some words call +1 (415) 555-0199 and more words here; later again call (415) 555-0199 or so, page 12 of 99"
    base = pii.base_spans(text)
    more = pii.added_spans(text, field, base)
    assert [text[s:e] for s, e, _ in more] == ["(415) 555-0199"] and {k for _, _, k in more} == {3}
    assert pii.added_spans("plain 12 words 7 only", field, []) == []


def test_propagation_on_a_tree_is_exact():
    rnd = np.random.default_rng(4)
    field = pii.Field({}, np.zeros(5), rnd.normal(size=(5, 5)), np.zeros((5, 5)))
    node, chain = rnd.normal(size=(4, 5)), [(0, 1), (1, 2), (2, 3)]
    got = pii.marginals(field, node, chain, [], {}, sweeps=200)
    want = np.zeros((4, 5))
    for a in np.ndindex(5, 5, 5, 5):
        p = np.exp(sum(node[i, a[i]] for i in range(4)) + sum(field.chain[a[i], a[i + 1]] for i in range(3)))
        for i in range(4):
            want[i, a[i]] += p
    assert np.allclose(got, want / want.sum(axis=1, keepdims=True), atol=1e-3)


def test_query_rows(spark):
    rows = [(i, t) for i, t in enumerate(corpus(40))] + [(90, None), (91, ""), (None, "ü a@b.cd"), (92, "x " * 30000 + "a@b.cd")]
    got = pii.find(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as found")).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[90].base_sha256 == by[91].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert by[None].spans == "email:2:8" and by[92].spans == "email:60000:60006"
    for i, t in rows[:40]:
        base = naive(t)
        want = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, e, k in base)
        assert by[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert set(want.split(",")) <= set(by[i].spans.split(","))
    assert pii.find(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def planted(seed, n):
    """Texts with an entity in a form that a pattern finds and, further on, in one that none does: (text, the
    place of the second form, its kind). Between them numbers that are none."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choices("abcdefghij", k=rnd.randint(2, 8)))
    out = []
    for _ in range(n):
        a, b, c = rnd.randint(200, 999), rnd.randint(200, 999), rnd.randint(1000, 9999)
        digits = [rnd.randint(0, 9) for _ in range(15)]
        digits[0] = 4
        check = next(d for d in range(10) if pii.luhn("".join(map(str, digits)) + str(d)))
        card = "".join(map(str, [*digits, check]))
        kind = rnd.choice([2, 3])
        if kind == 3:
            first, second = f"call +1 ({a}) {b}-{c}", f"{a}.{b}.{c}" if rnd.random() < 0.5 else f"({a}) {b}-{c}"
        else:
            first, second = "card " + " ".join(card[k : k + 4] for k in range(0, 16, 4)), ".".join(card[k : k + 4] for k in range(0, 16, 4))
        other = [f"License, Version {rnd.randint(1, 3)}.{rnd.randint(0, 9)}.", f"page {rnd.randint(1, 99)} of {rnd.randint(100, 999)}", f"in {rnd.randint(1900, 2030)},"]
        words = [word() for _ in range(20)]
        text = " ".join([*words[:5], first, *words[5:8], rnd.choice(other), *words[8:13], "again", ""])
        out.append((text + second + " " + " ".join([*words[13:], rnd.choice(other)]), (len(text), len(text) + len(second)), kind))
    return out


def test_precision_and_recall_of_added_spans_held_out():
    field = pii.train([t for t, *_ in planted(11, 600)])
    found = right = 0
    cases = planted(12, 300)
    for text, (s, e), kind in cases:
        more = pii.added_spans(text, field, pii.base_spans(text))
        found += len(more)
        right += any(k == kind and x < e and s < y for x, y, k in more)
    assert right / len(cases) > 0.8 and right / max(found, 1) > 0.9, (right, found, len(cases))


def test_versions_are_no_addresses():
    assert not pii.plausible("2.0", 1) and pii.plausible("10 . 0 . 0 . 1", 1) and not pii.plausible("1.2.3.400", 1)
    assert pii.plausible("555-010-0199", 3) and not pii.plausible("12 of 99", 3) and not pii.plausible("@", 0)


def test_long_lists_of_numbers_take_linear_time():
    field = pii.train(corpus())
    phones = " ".join(f"+1 ({200 + k % 700}) 555-{k % 9000 + 1000:04d}" for k in range(30_000))
    alike = "token 12345678 " * 30_000
    mixed = "1.2.3.4 x 2.0 " * 30_000
    for text in (phones, alike, mixed):
        began = time.perf_counter()
        base = pii.base_spans(text)
        pii.added_spans(text, field, base)
        assert time.perf_counter() - began < 60
