"""Repairing the turns of conversations by iterative-deepening A*.

A sound conversation has the roles of ``(s?(ua)+)?``: perhaps a system turn, then user
and assistant in turn, assistant last. The edits of a row are Keep, Rerole, Delete, and
before any row or at the end an empty turn may be Inserted. The cheapest list of edits
is searched depth first, edits in ASCII order (D, I, K, R), under a bound on the cost
that grows from a lower estimate to the least cost that any path went over it by. Among
the cheapest lists the first one found is therefore the ASCII-least.

What failed is kept in a table: for a place and a state, a cost below which nothing can
lead to the end. That holds under any bound, so the table outlives a round, and a state
is entered again only with more to spend than ever before. A search of n rows holds
four numbers a row.

The estimate sums up, from a place on, what no path avoids: 4 for each row that must go,
3 for each truncated row, and something for each run of illegal pairs of neighbours among
the rest. One edit mends at most two pairs, which then share a row, and costs 3 more, or
1 more where it deletes a truncated row (4 in place of 3).

On Spark a conversation is one key: its rows are dealt and sorted by conversation and
stream through one task. The search sees a byte per row, never texts; repeats are found
by a window over (conversation, role, text) before. To apply a repair the rows stream a
second time behind their list of edits, one batch at a time. So the memory needed is the
length of a list of edits, whatever the texts.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from furrow.llm.common import narrow

#: Costs of the edits, and what a truncated row costs that stays.
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
ROLES = {"u": "user", "a": "assistant", "s": "system"}
LEGAL = ("su", "ua", "au")
#: States: nothing yet, after system, after user, after assistant. The turn each one asks for.
START, SYSTEM, USER, ASSISTANT = range(4)
WANTED = ("u", "u", "a", "u")
#: State after a user or assistant turn.
AFTER = {"u": USER, "a": ASSISTANT}
SOUND = (START, ASSISTANT)
BLANKS = " \t\n\x0b\f\r"


def _mending(pairs: int, truncated: int) -> int:
    """The least extra cost of mending a run of illegal pairs, ``truncated`` of its rows being so."""
    edits = -(-pairs // 2)
    cheap = min(truncated, edits)
    return cheap * (DELETE - TRUNCATED) + (edits - cheap) * min(INSERT, REROLE)


def estimates(initials: str, faults: str) -> list[list[int]]:
    """``[state][place]``: no path from there costs less."""
    n = len(initials)
    out = [[0] * (n + 1) for _ in range(4)]
    # From a place on: costs that are certain, those of whole runs of illegal pairs behind the
    # first run, pairs and truncated rows of that run, and the first row that may stay.
    forced = behind = pairs = truncated = 0
    first = ""
    for i in range(n, -1, -1):
        if i < n and faults[i] in "bd":
            forced += DELETE
        elif i < n:
            own = int(faults[i] == "t")
            forced += TRUNCATED * own
            illegal = initials[i] != "a" if first == "" else initials[i] + first not in LEGAL
            if illegal:
                pairs, truncated = pairs + 1, truncated + own
            else:
                behind, pairs, truncated = behind + _mending(pairs, truncated), 0, own
            first = initials[i]
        for state in range(4):
            if first == "":
                enters = state not in SOUND
            else:
                enters = first != WANTED[state] and not (state == START and first == "s")
            out[state][i] = forced + behind + _mending(pairs + enters, truncated)
    return out


def cheapest_edits(initials: str, faults: str) -> tuple[int, str]:
    """Cost and ASCII-least list of the cheapest edits of rows given by the initial of
    their role and their fault: ``b`` blank, ``d`` duplicate, ``t`` truncated, ``-`` none."""
    n, bounds = len(initials), estimates(initials, faults)

    def steps(state: int, i: int) -> list[tuple[str, int, int, int]]:
        """Edits in ASCII order as (initial, cost, state, place)."""
        wanted = WANTED[state]
        after = AFTER[wanted]
        out = [("I", INSERT, after, i)]
        if i < n:
            out.insert(0, ("D", DELETE, state, i + 1))
            if faults[i] not in "bd":
                stays = TRUNCATED if faults[i] == "t" else 0
                if initials[i] == wanted:
                    out.append(("K", stays, after, i + 1))
                elif state == START and initials[i] == "s":
                    out.append(("K", stays, SYSTEM, i + 1))
                if initials[i] != wanted:
                    out.append(("R", REROLE + stays, after, i + 1))
        return out

    bound = bounds[START][0]
    while True:
        # The path in hand: place, state, budget left, edits still to try, best estimate through the edits tried.
        path: list[list] = [[0, START, bound, iter(steps(START, 0)), sys.maxsize]]
        audit: list[str] = []
        while path:
            i, state, left, untried, least = top = path[-1]
            if i == n and state in SOUND:
                return bound - left, "".join(audit)
            for edit, cost, after, j in untried:
                through = cost + bounds[after][j]
                if through > left:
                    top[4] = min(top[4], through)
                    continue
                path.append([j, after, left - cost, iter(steps(after, j)), sys.maxsize])
                audit.append(edit)
                break
            else:
                # Failed: whatever leads on from here costs more than what was left.
                bounds[state][i] = max(bounds[state][i], top[4])
                path.pop()
                if path:
                    audit.pop()
                    above = path[-1]
                    spent = above[2] - left
                    above[4] = min(above[4], spent + bounds[state][i])
        bound = bounds[START][0]


def fault_of(text: Column, repeated: Column) -> Column:
    """The first fault of a row as one letter."""
    last = F.substring(F.rtrim(text, F.lit(BLANKS)), -1, 1)
    return F.when(last == "", "b").when(repeated, "d").when(~last.isin(".", "!", "?"), "t").otherwise("-")


def _narrowed(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """The operator's own columns; nulls of role and text as one space, and the key without nulls."""
    base = narrow(rows, conv=conv_col, turn=turn_col, role=role_col, text=text_col)
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return base.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit("")).alias("key"),
        F.col("conv").cast("long"),
        F.col("turn").cast("long"),
        role.alias("role"),
        text.alias("text"),
        F.sha2(text, 256).alias("digest"),
    )


ORDER = ("key", "turn", "role", "digest")
PLAN = (
    "conv long, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "n_rows long, cost long, audit string"
)


def plans(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: ``conv``, ``gaps`` (turns missing between the least and
    the greatest), rows by first fault (``blank``, ``duplicate``, ``truncated``),
    ``illegal`` neighbours, ``n_rows``, and ``cost`` and ``audit`` of the cheapest repair.

    Rows are taken by turn, null first; rows of one turn by role, then by the SHA-256 of the
    text, which leaves equal rows only. A null role or text counts as one space: the row is
    blank, or its role fits nowhere. Rows without a conversation form one of their own.
    Very long texts are hashed whole. An empty table gives an empty one. Other columns
    are left behind, whatever they are called.
    """
    base = _narrowed(rows, conv_col, turn_col, role_col, text_col)
    earlier = Window.partitionBy("key", "role", "digest").orderBy("turn")
    coded = base.withColumn("nth", F.row_number().over(earlier)).select(
        "key", "conv", "turn", "role", "digest", "nth", F.substring("role", 1, 1).alias("initial"), fault_of(F.col("text"), F.col("nth") > 1).alias("fault")
    )
    ordered = coded.repartition("key").sortWithinPartitions(*ORDER, "nth").select("key", "conv", F.col("turn").cast("string"), "initial", "fault")
    return ordered.mapInPandas(_planned, PLAN)


def _planned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def closed(conv: int | None, initials: str, faults: str, span: tuple[int, int, int] | None) -> tuple:
        cost, audit = cheapest_edits(initials, faults)
        gaps = span[1] - span[0] + 1 - span[2] if span else 0
        illegal = sum(initials[i : i + 2] not in LEGAL for i in range(len(initials) - 1))
        return conv, gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, len(faults), cost, audit

    key = conv = None
    initials: list[str] = []
    faults: list[str] = []
    span: tuple[int, int, int] | None = None
    for batch in batches:
        out = []
        for k, c, turn, initial, fault in batch.itertuples(index=False, name=None):
            if k != key:
                if key is not None:
                    out.append(closed(conv, "".join(initials), "".join(faults), span))
                key, conv, initials, faults, span = k, k[1:] or None, [], [], None
            # One letter a row; a role without letters must not shift the others.
            initials.append(initial or " ")
            faults.append(fault)
            if turn is not None:
                t = int(turn)
                span = (t, t, 1) if span is None else (span[0], t, span[2] + (t != span[1]))
        if out:
            yield _plan_frame(out)
    if key is not None:
        yield _plan_frame([closed(conv, "".join(initials), "".join(faults), span)])


def _plan_frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=[c.split()[0] for c in PLAN.split(", ")])
    return out.assign(conv=[pd.NA if c is None else int(c) for c in out["conv"]]).astype({"conv": "Int64"})


def _edited(audit: str, texts: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """The turns after the edits: (edit, role, text). Rows are drawn one by one."""
    state = START
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(texts)
        if edit == "D":
            continue
        if edit in "IR":
            role = ROLES[WANTED[state]]
        state = SYSTEM if state == START and edit == "K" and role[:1] == "s" else AFTER[WANTED[state]]
        yield edit, role, text


def _with_audits(rows: DataFrame, planned: DataFrame, columns: tuple[str, str, str, str]) -> DataFrame:
    """The rows, each conversation's list of edits before them."""
    base = _narrowed(rows, *columns)
    plan_key = F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit(""))
    edits = planned.select(
        plan_key.alias("key"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("digest"), F.col("audit").alias("text")
    )
    texts = base.select("key", F.lit(1).alias("kind"), "turn", "role", "digest", "text")
    return edits.unionByName(texts).repartition("key").sortWithinPartitions("key", "kind", *ORDER[1:]).select("key", "kind", "role", "text")


def _streamed(batches: Iterator[pd.DataFrame], work: Callable[[str, str, Iterator[tuple[str, str]]], Iterator[tuple]], columns: list[str]) -> Iterator[pd.DataFrame]:
    """``work(key, audit, rows)`` per conversation, its rows drawn as they come."""
    stream = (row for batch in batches for row in batch.itertuples(index=False, name=None))
    held = next(stream, None)

    def texts(key: str) -> Iterator[tuple[str, str]]:
        nonlocal held
        while held is not None and held[0] == key:
            row, held = held, next(stream, None)
            yield row[2], row[3]

    out, chars = [], 0
    while held is not None:
        key, audit = held[0], held[3]
        held = next(stream, None)
        rest = texts(key)
        for row in work(key[1:], audit, rest):
            out.append(row)
            chars += sum(len(v) for v in row if isinstance(v, str))
            if len(out) >= 5_000 or chars > 4_000_000:
                yield _typed(out, columns)
                out, chars = [], 0
        for _ in rest:
            pass
    if out:
        yield _typed(out, columns)


def _typed(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=columns)
    return out.assign(conv=[int(c) if c else pd.NA for c in out["conv"]]).astype({"conv": "Int64"})


def repaired_rows(
    rows: DataFrame, planned: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """The turns of the repaired conversations: ``conv``, ``place`` (from 0), ``edit`` (I, K
    or R), ``role``, ``text``. ``planned`` comes from ``plans`` of the same rows. Awkward
    rows are treated as there; a conversation without turns gives none."""
    columns = ["conv", "place", "edit", "role", "text"]

    def work(key: str, audit: str, texts: Iterator[tuple[str, str]]) -> Iterator[tuple]:
        for place, turn in enumerate(_edited(audit, texts)):
            yield key, place, *turn

    dealt = _with_audits(rows, planned, (conv_col, turn_col, role_col, text_col))
    return dealt.mapInPandas(lambda batches: _streamed(batches, work, columns), "conv long, place long, edit string, role string, text string")


def repaired_digests(
    rows: DataFrame, planned: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv``, ``n_turns`` and ``repaired_sha256`` of the repaired ``role:text``, joined by
    newlines. The hash reads turn after turn. Awkward rows are treated as in ``plans``."""
    columns = ["conv", "n_turns", "repaired_sha256"]

    def work(key: str, audit: str, texts: Iterator[tuple[str, str]]) -> Iterator[tuple]:
        digest, n = hashlib.sha256(), 0
        for _, role, text in _edited(audit, texts):
            digest.update(f"{chr(10) if n else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
            n += 1
        yield key, n, digest.hexdigest()

    dealt = _with_audits(rows, planned, (conv_col, turn_col, role_col, text_col))
    return dealt.mapInPandas(lambda batches: _streamed(batches, work, columns), "conv long, n_turns long, repaired_sha256 string")
