"""Exact duplicates and repaired conversations against brute force."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest
from tests.llm.conftest import LONG, TEXTS
from hypothesis import given, settings
from hypothesis import strategies as st

from sheafwork.llm import conversations, exact_dedup
from sheafwork.llm.quotient_filter import QuotientFilter

# -- 11 ------------------------------------------------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, (1 << 20) - 1) | st.sampled_from([0, 1, (1 << 20) - 1]), max_size=60), max_size=5))
def test_filters_merge_without_loss(parts):
    filters = [QuotientFilter.of(np.array(p, np.uint64), 20) for p in parts]
    back = [QuotientFilter.from_bytes(f.to_bytes()) for f in filters]
    whole = QuotientFilter.from_bytes(QuotientFilter.merged([QuotientFilter.merged(back[:2], 20), *back[2:]], 20).to_bytes())
    assert dict(zip(whole.fps.tolist(), whole.counts.tolist())) == Counter(x for p in parts for x in p)
    assert whole.fps.tolist() == sorted(whole.fps.tolist())


def test_filter_of_whole_words():
    x = np.array([0, (1 << 64) - 1, 1 << 63, 5, 5, 5], np.uint64)
    f = QuotientFilter.from_bytes(QuotientFilter.of(x).to_bytes())
    assert dict(zip(f.fps.tolist(), f.counts.tolist())) == {0: 1, 5: 3, 1 << 63: 1, (1 << 64) - 1: 1}


def brute_duplicates(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    out = []
    for t, ids in groups.items():
        known = sorted(i for i in ids if i is not None)
        keep = known[0] if known else None
        left = 1
        for i in ids:
            stays = left and i == keep
            left -= bool(stays)
            out.append((i, keep, len(ids), bool(stays), hashlib.sha256(t.encode()).hexdigest()))
    return sorted(map(str, out))


@pytest.mark.parametrize("bits, few", [(64, 10**6), (3, 10**6), (3, 0)])
def test_exact_duplicates(spark, docs, no_docs, monkeypatch, bits, few):
    monkeypatch.setattr(exact_dedup, "BROADCAST", few)
    monkeypatch.setattr(exact_dedup, "HELD", 4)
    more = [(20, "a  b"), (21, "a\tb"), (22, "a b "), (23, " a b"), (None, "a b"), (24, "a b"), (25, LONG.replace(" ", "\n ")), (None, None), (26, ""), (19, "a b"), (19, "a b"), (None, "none"), (None, "none")]
    every = docs.select("doc_id", "text", "fp", "hash").unionByName(spark.createDataFrame([(*r, 1, "x") for r in more], "doc_id bigint, text string, fp bigint, hash string"))
    got = exact_dedup.exact_duplicates(every, bits).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(str, map(tuple, got))) == brute_duplicates([(i, t) for i, t, *_ in TEXTS] + more)
    assert exact_dedup.exact_duplicates(no_docs, bits).count() == 0


def test_a_large_group_of_copies(spark):
    df = spark.range(60_000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'the same  text', CONCAT('own ', id)) AS text")
    got = exact_dedup.exact_duplicates(df)
    assert got.where("kept").count() == 40_001
    assert got.where("group_size = 20000 AND keep_id = 0").count() == 20_000


# -- 13 ------------------------------------------------------------------------------------------------------------------


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        sp = lambda x: " " if x is None else x
        kind = zlib.crc32(f"{sp(conv)}:{sp(turn)}".encode()) % 20
        role, text = sp(role), sp(text)
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        row = (conv, turn, "user" if kind == 4 else role, text)
        out += [row] * (2 if kind == 3 else 1)
    return sorted(out, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))


def brute_repair(rows):
    """rows: damaged rows of one conversation; all edits are tried."""
    seen, faults = set(), []
    for _, _, role, text in rows:
        last = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
        seen.add((role, text))
    best = None
    for edits in product(["K", "D", "Ru", "Ra"], repeat=len(rows)):
        cost, options = 0, []
        for e, f, r in zip(edits, faults, rows):
            if e != "D" and f in ("blank", "duplicate") or e == "K" and r[2][:1] not in ("s", "u", "a"):
                break
            cost += {"K": 0, "D": 4}.get(e, 3) + (3 if f == "truncated" and e != "D" else 0)
        else:
            for where in product(range(3), repeat=len(rows) + 1):
                n = sum(where)
                if best and cost + 3 * n > best[0]:
                    continue
                for kinds in product("ua", repeat=n):
                    k, audit, roles, lines = iter(kinds), "", "", []
                    for i in range(len(rows) + 1):
                        for _ in range(where[i]):
                            x = next(k)
                            audit += "I"
                            roles += x
                            lines.append({"u": "user:", "a": "assistant:"}[x])
                        if i < len(rows):
                            e = edits[i]
                            audit += e[0]
                            if e == "K":
                                roles += rows[i][2][:1]
                                lines.append(f"{rows[i][2]}:{rows[i][3]}")
                            elif e != "D":
                                roles += e[1]
                                lines.append({"Ru": "user:", "Ra": "assistant:"}[e] + rows[i][3])
                    if re.fullmatch("(s?(ua)+)?", roles):
                        best = min([x for x in (best, (cost + 3 * n, audit, "\n".join(lines))) if x], key=lambda x: x[:2])
    turns = [r[1] for r in rows if r[1] is not None]
    ini = [r[2][:1] for r in rows]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    count = lambda f: sum(x == f for x in faults)
    return (gaps, count("blank"), count("duplicate"), count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(ini, ini[1:])), best[0], best[1], hashlib.sha256(best[2].encode()).hexdigest())


def small_world():
    rng = np.random.default_rng(5)
    pick = lambda xs, p=None: xs[rng.choice(len(xs), p=p)]
    roles = ["user", "assistant", "system", "tool", "", None]
    texts = ["Hi there.", "Yes!", "no end", " \n", "", None, "So?  \t"]
    rows = []
    for conv in [*range(60), None]:
        for t in range(int(rng.integers(1, 4))):
            rows.append((conv, pick([t, t, t, None, t + 5]), pick(roles, [0.35, 0.35, 0.1, 0.1, 0.05, 0.05]), pick(texts)))
    return rows


@pytest.mark.parametrize("most", [4096, 1])
def test_repair_by_brute_force(spark, monkeypatch, most):
    """All conversations in rows of their own, then all as ranges of larger ones."""
    monkeypatch.setattr(conversations, "MOST_ROWS", most)
    if most == 1:
        monkeypatch.setattr(conversations, "MOST_BYTES", 1)
    rows = small_world()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, cost int, pos string")
    got = {r["conv_id"]: tuple(r)[1:] for r in conversations.repaired_conversations(df).collect()}
    want = {c: brute_repair(damage([r for r in rows if r[0] == c])) for c in {r[0] for r in rows}}
    assert got == want


def test_one_very_large_conversation(spark, monkeypatch):
    """A conversation of many ranges gives what one fold over all its rows gives."""
    rows = spark.range(9000).selectExpr("CAST(id % 2 AS BIGINT) AS conv_id", "IF(id % 50 = 0, NULL, id DIV 4) AS turn", "IF(id % 7 < 4, 'user', 'assistant') AS role", "IF(id % 11 = 0, 'Same.', CONCAT('text ', id % 900, IF(id % 5 = 0, '', '.'))) AS text")
    monkeypatch.setattr(conversations, "MOST_ROWS", 10**6)
    one = sorted(map(tuple, conversations.repaired_conversations(rows).collect()))
    monkeypatch.setattr(conversations, "MOST_ROWS", 500)
    assert sorted(map(tuple, conversations.repaired_conversations(rows).collect())) == one


def test_conversation_edges(spark):
    kind = "conv_id bigint, turn bigint, role string, text string"
    assert conversations.repaired_conversations(spark.createDataFrame([], kind)).count() == 0
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = spark.createDataFrame([(gone, 0, "user", "Hi."), (7, -(1 << 63), "user", LONG + "."), (7, (1 << 63) - 1, "assistant", "Done.")], kind)
    got = {r["conv_id"]: tuple(r)[1:] for r in conversations.repaired_conversations(rows).collect()}
    assert got[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got[7][0] is None  # beyond bigint
