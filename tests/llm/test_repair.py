from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tillwright.llm import queries, repair

CONVERSATION = "conv_id bigint, turn bigint, role string, text string"
PATTERN = re.compile("(s?(ua)+)?")


def _kinds(rows):
    seen, out = set(), []
    for role, text in rows:
        letters = re.findall(r"[^\x20\x09-\x0D]", text)
        kind = "sound"
        if not letters:
            kind = "blank"
        elif (role, text) in seen:
            kind = "duplicate"
        elif letters[-1] not in ".!?":
            kind = "truncated"
        seen.add((role, text))
        out.append(kind)
    return out


def _cheapest(rows, kinds):
    """(cost, audit, initials) by trying edits from the last row to the first, for every state."""
    after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    def closed(best):
        found = dict(best)
        for _ in range(4):
            for state in after:
                for c, to in after[state].items():
                    if c != "s" and to in found:
                        cost, audit, made = found[to]
                        option = (cost + 3, "I" + audit, c + "I" + made)
                        found[state] = min(found.get(state, option), option)
        return found

    best = closed({"": (0, "", ""), "a": (0, "", "")})
    for (role, _), kind in zip(reversed(rows), reversed(kinds)):
        now = {}
        for state in after:
            options = []
            if state in best:
                cost, audit, made = best[state]
                options.append((cost + 4, "D" + audit, "-D" + made))
            if kind in ("sound", "truncated"):
                more = 3 * (kind == "truncated")
                for c, to in after[state].items():
                    if to not in best:
                        continue
                    cost, audit, made = best[to]
                    if role[:1] == c:
                        options.append((cost + more, "K" + audit, c + "K" + made))
                    if c != "s":
                        options.append((cost + more + 3, "R" + audit, c + "R" + made))
            if options:
                now[state] = min(options)
        best = closed(now)
    return best[""]


def _plain(conversations):
    """What the query should return, by conversation; rows are (conv_id, turn, role, text)."""
    out = {}
    name = lambda x: " " if x is None else str(x)
    for conv in {r[0] for r in conversations}:
        rows = []
        for _, turn, role, text in (r for r in conversations if r[0] == conv):
            role, text = name(role), name(text)
            fault = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
            if fault == 0:
                continue
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            role = "user" if fault == 4 else role
            rows += [(turn, role, text)] * (2 if fault == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        turns = [r[0] for r in rows if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        rows = [r[1:] for r in rows]
        kinds = _kinds(rows)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
        cost, audit, made = _cheapest(rows, kinds)
        left, texts = iter(rows), []
        for initial, edit in zip(made[0::2], made[1::2]):
            role = {"s": "system", "u": "user", "a": "assistant"}.get(initial)
            if edit == "I":
                texts.append(role + ":")
                continue
            own, text = next(left)
            if edit != "D":
                texts.append((own if edit == "K" else role) + ":" + text)
        assert PATTERN.fullmatch(made[0::2].replace("-", ""))
        digest = hashlib.sha256("\n".join(texts).encode()).hexdigest()
        faults = [kinds.count(k) for k in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *faults, illegal, cost, audit, digest)
    return out


def _random(seed=3, conversations=150):
    rng = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", None, "tool", "", "sage", "User"]
    texts = ["Yes.", "No!", "what", "", None, " \n", "Why? ", "odd é", "end.\t", "a.b"]
    rows = []
    for conv in range(conversations):
        for turn in range(rng.choice([0, 1, 2, 5, 9, 30])):
            for _ in range(rng.choice([1, 1, 1, 1, 2])):
                text = rng.choice(texts)
                text = text if rng.random() < 0.5 else f"{text} {rng.randrange(100)}{rng.choice('. ?')}"
                rows.append((conv, None if rng.random() < 0.05 else turn * rng.choice([1, 1, 2]), rng.choice(roles), text))
    rows += [(None, t, "user", "Null id.") for t in (1, 2, None)] + [(900, 0, "user", "Same.")] * 40
    rows += [(901, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(700)]
    return rows


def _check(rows, conversations):
    expected = _plain(conversations)
    found = {r["conv_id"]: tuple(r)[1:] for r in rows}
    assert len(rows) == len(found)
    assert found == expected


@pytest.mark.parametrize("partitions", [1, 7])
def test_random_conversations(spark, partitions):
    rows = _random()
    table = spark.createDataFrame(rows, CONVERSATION).withColumns({c: F.lit(1) for c in ("digest", "copies", "step", "cost", "kind")})
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        _check(repair.report(table).collect(), rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect()]
    _check(queries.op12_repair(spark, SMALL).collect(), rows)


def test_repaired_rows_read_as_they_should(spark):
    rows = _random(7, 60)
    found = repair.repaired(spark.createDataFrame(rows, CONVERSATION)).collect()
    by_conversation = {}
    for r in sorted(found, key=lambda r: (r["conv_id"] is None, r["conv_id"] or 0, r["position"])):
        by_conversation.setdefault(r["conv_id"], []).append(r)
    for own in by_conversation.values():
        assert [r["position"] for r in own] == list(range(len(own)))
        assert PATTERN.fullmatch("".join(r["role"][0] for r in own))
    sound = [(r["position"], r["role"], r["text"]) for r in by_conversation[901]]
    assert sound == [(t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(700)]


def test_cells_of_equal_rows():
    cell = repair._row("u-")
    for n in (1, 2, 3, 7, 12):
        plain = repair._short(("u-",) * n)
        assert repair.times(cell, n) == plain
    # every way to cut a span gives the same cell
    rows = ("u", "u!", "a-", "s", "a", "?", "u", "a!", "a")
    whole = repair._short(rows)
    for cut in range(1, len(rows)):
        assert repair.join(repair._short(rows[:cut]), repair._short(rows[cut:])) == whole


def test_empty_table(spark):
    empty = spark.createDataFrame([], CONVERSATION)
    assert repair.report(empty).count() == 0
    assert repair.repaired(empty).count() == 0
