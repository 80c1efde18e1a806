"""Interval parsing against a left-to-right search, on random, odd and long conversations."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortcraft.llm import conversation_repair as repair
from cohortcraft.llm.queries import op11_conversation_repair

CONTENT = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(kinds):
    """Least (cost, audit) by trying every edit of the next turn; states: start, user next, assistant next, end of a pair."""

    @lru_cache(None)
    def rest(i, state, inserted):
        found = [(0, "")] if i == len(kinds) and state in ("start", "pair") else []
        following = {"start": "answer", "open": "answer", "answer": "pair", "pair": "answer"}[state]
        if inserted < 3:
            cost, audit = rest(i, following, inserted + 1)
            found.append((cost + 5, "I" + audit))
        if i < len(kinds):
            kind = kinds[i]
            cost, audit = rest(i + 1, state, 0)
            found.append((cost + 2, "D" + audit))
            if kind != "x":
                more = 5 if kind.isupper() else 0
                cost, audit = rest(i + 1, following, 0)
                found.append((cost + 1 + more, "R" + audit))
                if kind.lower() == ("a" if state == "answer" else "u"):
                    found.append((cost + more, "K" + audit))
                if kind.lower() == "s" and state == "start":
                    cost, audit = rest(i + 1, "open", 0)
                    found.append((cost + more, "K" + audit))
        return min(found, default=(10**9, ""))

    for i in range(len(kinds), 0, -1):  # from the end, so long conversations do not recurse deeply
        for state in ("start", "open", "answer", "pair"):
            rest(i, state, 0)
    return rest(0, "start", 0)


def brute(rows):
    """{conv_id: summary} of undamaged-contract rows (conv_id, turn, role, text), by plain Python."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        faults, seen, kinds = [], set(), ""
        for _, role, text in mine:
            content = CONTENT.findall(text)
            fault = "blank" if not content else "duplicate" if (role, text) in seen else "truncated" if content[-1] not in ".!?" else None
            seen.add((role, text))
            faults.append(fault)
            initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
            kinds += "x" if fault in ("blank", "duplicate") else initial.upper() if fault else initial
        turns = [t for t, _, _ in mine if t is not None]
        cost, audit = cheapest(kinds)
        lines, at, expected = [], 0, ""
        for letter in audit:
            _, role, text = mine[at] if letter != "I" else (None, None, "")
            at += letter != "I"
            if letter == "D":
                continue
            if letter != "K":
                role = {"u": "user", "a": "assistant"}[expected or "u"]
            lines.append(f"{role}:{text}")
            expected = "u" if letter == "K" and not expected and role[:1] == "s" else "a" if (expected or "u") == "u" else "u"
        out[conv] = {
            "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
            "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:])),
            "cost": cost,
            "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        }
    return out


def by_operator(df):
    summaries, turns = repair.repair(df)
    hashes = {r["conv_id"]: r["repaired_sha256"] for r in repair.text_hashes(turns).collect()}
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    return {
        r["conv_id"]: {**{n: r[n] for n in names}, "repaired_sha256": hashes.get(r["conv_id"], repair.EMPTY_HASH)}
        for r in summaries.collect()
    }


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="xsuaoSUAO", max_size=11))
def test_chart_is_the_cheapest_repair(kinds):
    assert repair.answer(repair.chart(kinds)) == cheapest(kinds)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="xxsuaouaUA", min_size=13, max_size=90))
def test_joined_charts_equal_the_search(kinds):
    assert repair.answer(repair.parse(kinds)) == cheapest(kinds)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="xsuaoSUAO", min_size=2, max_size=9))
def test_every_cut_gives_the_same_cell(kinds):
    whole = repair.chart(kinds)
    for k in range(1, len(kinds)):
        assert repair.join(repair.chart(kinds[:k]), repair.chart(kinds[k:])) == whole


SCHEMA = "conv_id long, turn long, role string, text string"


def conversations(seed, n):
    rng = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"]
    texts = ["Yes.", "No!", "Why?", "open end", "", " \n", None, "é.", "It is.\nSo? ", "end.)"]
    return [
        (conv, rng.choice([None, *range(12)]), rng.choice(roles), rng.choice(texts))
        for conv in range(n)
        for _ in range(rng.randint(1, 14))
    ]


def test_repair_against_plain_python(spark):
    rows = conversations(1, 150) + [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (None, 2, "assistant", "Ho.")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS copies", "2 AS digest", "3 AS position", "'x' AS fault")
    assert by_operator(df) == brute(rows)


def test_one_conversation_over_many_tasks(spark):
    """A third of all rows in one conversation, dealt over the tasks of a sort; some rows hundreds of times."""
    rng = random.Random(2)
    rows = [(7, t, rng.choice(["user", "assistant"]), f"Turn {rng.randrange(400)}." if t % 5 else "cut") for t in range(600)]
    rows += [(7, 300, "user", "Again.")] * 300 + [(i, 0, "user", "Hi.") for i in range(100, 110)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small data would be put back into one task
    try:
        summaries, turns = repair.repair(df)
        assert by_operator(df) == brute(rows)
        marked = repair.compact(df).repartitionByRange(4, *repair._COMPACT).sortWithinPartitions(*repair._COMPACT)
        assert marked.mapInArrow(repair._spans, repair._SPAN).where("conv_id = 7").count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    told = [r for r in turns.collect() if r["conv_id"] == 7]
    assert [r["position"] for r in told] == list(range(len(told)))
    assert [r["role"] for r in told] == ["user", "assistant"] * (len(told) // 2)


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    summaries, turns = repair.repair(empty)
    assert summaries.count() == 0 and turns.count() == 0
    long_text = "word " * 200_000 + "end."
    rows = [(1, None, None, None), (1, None, "user", long_text), (1, 5, "user", long_text), (2, None, "", "")]
    assert by_operator(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def damage(rows):
    out = []
    for c, t, r, x in rows:
        c_, t_ = (" " if v is None else v for v in (c, t))
        r, x = " " if r is None else r, " " if x is None else x
        draw = zlib.crc32(f"{c_}:{t_}".encode()) % 20
        if draw == 0:
            continue
        x = "" if draw == 1 else re.sub("[.!?]", "", x) if draw == 2 else x
        out += [(c, t, "user" if draw == 4 else r, x)] * (2 if draw == 3 else 1)
    return out


@pytest.mark.parametrize("source", ["table", "random"])
def test_query_against_plain_python(spark, tmp_path, source):
    d = "/root/testdata/sf0.001"
    if source == "random":
        d = str(tmp_path)
        spark.createDataFrame(conversations(3, 200) + [(None, None, None, None)], SCHEMA).write.parquet(f"{d}/conversations.parquet")
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in spark.read.parquet(f"{d}/conversations.parquet").collect()]
    want = brute(damage(rows))
    nothing = {**dict.fromkeys(["gaps", "blank", "duplicate", "truncated", "illegal", "cost"], 0), "audit": "", "repaired_sha256": repair.EMPTY_HASH}
    got = op11_conversation_repair(spark, d).collect()
    assert len(got) == len({r[0] for r in rows})
    assert {r["conv_id"]: {k: r[k] for k in nothing} for r in got} == {c: want.get(c, nothing) for c in {r[0] for r in rows}}
