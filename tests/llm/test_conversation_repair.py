import hashlib
import itertools
import random
import re

import pytest

from furrow.llm import conversation_repair as cr
from furrow.llm import entries

SHAPE = "conv_id long, turn long, role string, text string, key string, kind int, conv int, audit string"
SOUND = re.compile(r"(s?(ua)+)?\Z")


def dealt(initials, faults, audit):
    """Cost of a list of edits with every choice of roles, or None if none is allowed."""
    costs = []
    for roles in itertools.product("ua", repeat=sum(e in "IR" for e in audit)):
        pick, i, cost, out = iter(roles), 0, 0, ""
        for edit in audit:
            if edit == "I":
                cost, out = cost + 3, out + next(pick)
                continue
            if i == len(initials) or (edit != "D" and faults[i] in "bd"):
                break
            if edit == "D":
                cost += 4
            else:
                cost += 3 * (edit == "R") + 3 * (faults[i] == "t")
                out += next(pick) if edit == "R" else initials[i]
            i += 1
        else:
            if i == len(initials) and SOUND.match(out):
                costs.append(cost)
    return min(costs, default=None)


def every_list(initials, faults, longest):
    """The cheapest list by trying all lists of edits up to a length."""
    found = []
    for n in range(longest + 1):
        for audit in map("".join, itertools.product("DIKR", repeat=n)):
            cost = dealt(initials, faults, audit)
            if cost is not None:
                found.append((cost, audit))
    return min(found)


def by_table(initials, faults):
    """The cheapest list by a forward table over (place, state), for longer rows."""
    insert = {0: [(0, 0, ""), (2, 3, "I"), (3, 6, "II")], 1: [(1, 0, ""), (2, 3, "I"), (3, 6, "II")]}
    insert |= {2: [(2, 0, ""), (3, 3, "I")], 3: [(3, 0, ""), (2, 3, "I")]}
    best = {q: (c, a) for q, c, a in insert[0]}
    for x, fault in zip(initials, faults, strict=True):
        new = {}
        for q, (c, a) in best.items():
            steps = [(q, 4, "D")]
            if fault not in "bd":
                after, stay = (3 if q == 2 else 2), 3 * (fault == "t")
                steps.append((after, 3 + stay, "R"))
                if x == "uuau"[q]:
                    steps.append((after, stay, "K"))
                if q == 0 and x == "s":
                    steps.append((1, stay, "K"))
            for q1, c1, a1 in steps:
                for q2, c2, a2 in insert[q1]:
                    new[q2] = min(new.get(q2, (10**9, "")), (c + c1 + c2, a + a1 + a2))
        best = new
    return min(v for q, v in best.items() if q in (0, 3))


def test_cheapest_and_first_of_all_lists():
    r = random.Random(1)
    for _ in range(60):
        n = r.randrange(4)
        rows = "".join(r.choice("suax") for _ in range(n)), "".join(r.choice("--bdt") for _ in range(n))
        assert cr.cheapest_edits(*rows) == every_list(*rows, 5) == by_table(*rows)


def test_search_gives_what_a_table_gives():
    r = random.Random(2)
    for _ in range(4_000):
        n = r.randrange(14)
        rows = "".join(r.choice("suaux") for _ in range(n)), "".join(r.choice("--bdt") for _ in range(n))
        cost, audit = by_table(*rows)
        assert cr.cheapest_edits(*rows) == (cost, audit)
        assert cr.estimates(*rows)[0][0] <= cost
    long = "".join(r.choice("uaua" if r.random() < 0.9 else "s") for _ in range(400)), "".join(r.choice("-----bdt") for _ in range(400))
    assert cr.cheapest_edits(*long) == by_table(*long)
    assert cr.cheapest_edits("u" * 3_000, "-" * 3_000)[0] == 4_500


def conversations(spark):
    r, rows = random.Random(3), []
    for c in range(120):
        turns = [(c, t, "user" if t % 2 == 0 else "assistant", f"Words {c * (t % 3 > 0)} {t % 5}.") for t in range(r.randrange(1, 9))]
        if c % 4 == 0:
            turns = [(c, -1, "system", "Be kind."), *turns]
        for i in range(len(turns)):
            z = r.randrange(12)
            role, text = turns[i][2:]
            if z == 0:
                text = r.choice(["", " \t\n", "\x0b\x0c\r "])
            elif z == 1:
                text = text.rstrip(".") + r.choice(["", " ", "…", " "])
            elif z == 2:
                role = r.choice(["user", "tool", "", "System", "assistant"])
            turns[i] = (c, turns[i][1], role, text)
        rows += turns + [turns[0]] * (c % 5 == 0)
    rows += [(500, None, "user", "No turn."), (500, None, "assistant", "None."), (501, 3, None, "No role."), (502, 4, "user", None), (None, 1, "user", "Hi!"), (None, 2, "assistant", "Yes?")]
    rows += [(503, 1, "user", "long " * 200_000 + "."), (503, 9, "assistant", "short!"), (504, 2, "system", "alone.")]
    rows += [(1_000 + c, 0, "user", f"Only turn {c}?") for c in range(80)]
    return spark.createDataFrame([(*t, "k", 1, 2, "a") for t in rows], SHAPE)


def by_hand(rows):
    """Each conversation alone, with the table in place of the search."""
    out, groups = {}, {}
    for r in rows:
        groups.setdefault(r.conv_id, []).append((r.turn, r.role if r.role is not None else " ", r.text if r.text is not None else " "))
    for conv, own in groups.items():
        own.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.sha256(x[2].encode()).hexdigest()))
        seen, faults = set(), ""
        for _, role, text in own:
            bare = text.strip(" \t\n\x0b\x0c\r")
            faults += "b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "-"
            seen.add((role, text))
        initials = "".join(role[:1] or " " for _, role, _ in own)
        cost, audit = by_table(initials, faults)
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        state, kept, left = 0, [], iter(own)
        for edit in audit:
            role, text = next(left)[1:] if edit != "I" else ("", "")
            if edit == "D":
                continue
            if edit in "IR":
                role = "assistant" if state == 2 else "user"
            kept.append((edit, role, text))
            state = 1 if edit == "K" and role[:1] == "s" else 3 if state == 2 else 2
        out[conv] = (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, len(own), cost, audit, kept)
    return out


@pytest.fixture(scope="module")
def planned(spark):
    rows = conversations(spark)
    return rows, cr.plans(rows.repartition(7)), by_hand(rows.collect())


def test_plans(planned):
    _, plans, wanted = planned
    found = plans.collect()
    assert len(found) == len(wanted)
    assert {r.conv: tuple(r)[1:] for r in found} == {c: w[:-1] for c, w in wanted.items()}


def test_repaired_rows_and_hashes(planned):
    rows, plans, wanted = planned
    turns = {}
    for r in sorted(cr.repaired_rows(rows, plans).collect(), key=lambda r: r.place):
        turns.setdefault(r.conv, []).append((r.edit, r.role, r.text))
    assert turns == {c: w[-1] for c, w in wanted.items() if w[-1]}
    assert all(SOUND.match("".join(role[0] for _, role, _ in t)) for t in turns.values())
    digests = {r.conv: (r.n_turns, r.repaired_sha256) for r in cr.repaired_digests(rows, plans).collect()}
    texts = {c: "\n".join(f"{role}:{text}" for _, role, text in w[-1]) for c, w in wanted.items()}
    assert digests == {c: (len(wanted[c][-1]), hashlib.sha256(t.encode()).hexdigest()) for c, t in texts.items()}


def test_a_sound_conversation_stays(spark):
    rows = spark.createDataFrame([(1, 0, "system", "S."), (1, 1, "user", "U?"), (1, 2, "assistant", "A!")], "conv_id long, turn long, role string, text string")
    one = cr.plans(rows).collect()[0]
    assert (one.cost, one.audit) == (0, "KKK")
    assert [tuple(r)[2:] for r in cr.repaired_rows(rows, cr.plans(rows)).collect()] == [("K", "system", "S."), ("K", "user", "U?"), ("K", "assistant", "A!")]


def test_empty_table(spark):
    none = spark.createDataFrame([], SHAPE)
    plans = cr.plans(none)
    assert plans.count() == 0 and cr.repaired_rows(none, plans).count() == 0 and cr.repaired_digests(none, plans).count() == 0
    assert entries.damaged(none).count() == 0


def test_the_query_keeps_conversations_that_lose_every_row(spark, tmp_path):
    rows = conversations(spark)
    rows.write.parquet(f"{tmp_path}/conversations.parquet")
    found = {r.conv_id: r for r in entries.op13_conversation_repair(spark, str(tmp_path)).collect()}
    assert set(found) == {r.conv_id for r in rows.collect()}
    left = by_hand(entries.damaged(rows).collect())
    gone = set(found) - set(left)
    assert gone
    for conv in gone:
        assert tuple(found[conv])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    for conv, w in left.items():
        assert tuple(found[conv])[1:8] == (*w[:5], *w[6:8])
