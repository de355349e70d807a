import hashlib
import itertools
import random
import zlib

import pytest
from changemill.llm import conversation_repair as repair

WHITE = " \t\n\x0b\x0c\r"
NEXT = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
SCHEMA = "conv_id long, turn long, role string, text string, pos long, seg long, c string"


def damaged(rows):
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else " " if text is None else text
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        role = "user" if kind == 4 else " " if role is None else role
        yield from [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)


def cheapest(rows):
    """(cost, audit, repaired) of [(role, text, fault)]: whole strings, any number of inserts."""

    def keep(best, state, value):
        if state is not None and (state not in best or value[:2] < best[state][:2]):
            best[state] = value

    def inserted(best):
        for _ in range(3):
            for state, (cost, audit, out) in list(best.items()):
                for initial, role in (("u", "user"), ("a", "assistant")):
                    keep(best, NEXT[state].get(initial), (cost + 5, audit + "I", (*out, (role, ""))))
        return best

    best = inserted({"": (0, "", ())})
    for role, text, fault in rows:
        after = {}
        for state, (cost, audit, out) in best.items():
            keep(after, state, (cost + 2, audit + "D", out))
            if fault not in ("b", "d"):
                cost += 5 if fault == "t" else 0
                keep(after, NEXT[state].get(role[:1]), (cost, audit + "K", (*out, (role, text))))
                for initial, other in (("u", "user"), ("a", "assistant")):
                    keep(after, NEXT[state].get(initial), (cost + 1, audit + "R", (*out, (other, text))))
        best = inserted(after)
    return min((best[s] for s in ("", "a") if s in best), key=lambda v: v[:2])


def expected(rows):
    out = []
    hurt = sorted(damaged(rows), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).hexdigest()))
    for conv in {r[0] for r in rows}:
        mine, seen, faults = [r for r in hurt if r[0] == conv], set(), []
        for _, _, role, text in mine:
            bare = text.strip(WHITE)
            faults.append("b" if not bare else "d" if (role, text) in seen else "" if bare[-1] in ".!?" else "t")
            seen.add((role, text))
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(mine))
        cost, audit, left = cheapest([(r[2], r[3], f) for r, f in zip(mine, faults)])
        digest = hashlib.sha256("\n".join(f"{a}:{b}" for a, b in left).encode()).hexdigest()
        out.append((conv, gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, digest))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    texts = [None, "", " ", " \n", "Hi.", "no", "Yes! ", "x?\n", "é.", "cut off", *[f"t{k}." for k in range(30)]]
    roles = [None, "", "user", "assistant", "system", "tool", "user", "assistant"]
    out = [(rng.choice([None, *range(90)]), rng.choice([None, *range(12)]), rng.choice(roles), rng.choice(texts)) for _ in range(1200)]
    out += [(1000, t, rng.choice(["user", "assistant"]), f"text {t}{rng.choice('...x')}") for t in range(300)]
    return [*out, (2000, 0, "system", "Only this."), (2001, 3, "user", "x" * 50_000 + "."), *out[:5]]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 5, 1, "x") for r in rows], SCHEMA).repartition(3)


def found(conv):
    return sorted(map(tuple, repair.repair(repair.damage(conv), conv).collect()), key=repr)


@pytest.mark.parametrize("bits", [12, 3, 0])
def test_repair(spark, rows, monkeypatch, bits):
    monkeypatch.setattr(repair, "SEGMENT", bits)  # long conversations in segments give the same
    assert found(frame(spark, rows)) == expected(rows)


def test_empty(spark, rows):
    assert found(frame(spark, [])) == []
    assert found(frame(spark, rows[:1])) == expected(rows[:1])


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "Be good."), (1, 1, "user", "Hi."), (1, 2, "user", "Hi!"), (1, 4, "assistant", "No."), (2, 0, "user", "Alone.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = sorted(map(tuple, repair.repaired_rows(df).collect()))
    # of the two users the first goes: KDKK is less than KKDK
    assert out == [(1, 0, "K", "system", "Be good."), (1, 1, "K", "user", "Hi!"), (1, 2, "K", "assistant", "No.")]


def test_audits_compare_like_their_texts():
    rng = random.Random(3)
    labels = ["D", "K", "R", "IK", "IR"]
    audits = [repair.Audit(None, "")]
    for depth in range(60):
        audits = [repair.Audit(rng.choice(audits), x) for x in rng.sample(labels, 4)]
        for a, b in itertools.product(audits, repeat=2):
            assert repair.less(a, b) == (a.text() < b.text())
            assert repair.same(a, b) == (a.text() == b.text())
    assert len(audits[0].up) == 6


def test_equal_hashes_are_checked(monkeypatch):
    monkeypatch.setattr(repair, "PRIME", 1)  # every hash is zero
    rng = random.Random(5)
    rows = [(rng.choice("suax"), "x", rng.choice(["", "t", "b"])) for _ in range(120)]
    kinds = {"": repair.WHOLE, "t": repair.TRUNCATED, "b": repair.DELETE_ONLY}
    now = {repair.NOTHING: (0, repair.Audit(None, ""))}
    for role, _, fault in rows:
        now = repair.step(now, role, kinds[fault])
    assert repair.closed(now) == cheapest(rows)[:2]


def test_shared_prefixes():
    """Four audits of 500 labels are two chains: all deleted, and the rest on one stem."""
    now = {repair.NOTHING: (0, repair.Audit(None, ""))}
    for k in range(500):
        now = repair.step(now, "ua"[k % 2], repair.WHOLE)
    seen = {id(x) for _, audit in now.values() for x in audit.labels()}
    assert len(seen) < 1020
