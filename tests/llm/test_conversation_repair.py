import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from helpers import SF01, frame

from capset.llm import conversation_repair as R

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def cheapest_of_all(turns):
    """All edits with up to two inserts in a place, by the rules' words: turns are (initial, fault)."""
    inserts = [(), *itertools.product("ua", repeat=1), *itertools.product("ua", repeat=2)]
    best = None
    for gaps in itertools.product(inserts, repeat=len(turns) + 1):
        for acts in itertools.product("KDua", repeat=len(turns)):
            cost, audit, roles = 0, "", ""
            for n in range(len(turns) + 1):
                cost, audit, roles = cost + 2 * len(gaps[n]), audit + "I" * len(gaps[n]), roles + "".join(gaps[n])
                if n == len(turns):
                    break
                (initial, fault), act = turns[n], acts[n]
                if fault in ("blank", "duplicate") and act != "D":
                    break
                cost += {"K": 0, "D": 3}.get(act, 2) + (act != "D" and fault == "truncated")
                audit += act if act in "KD" else "R"
                roles += "" if act == "D" else initial if act == "K" else act
            else:
                continue
            if n == len(turns) and re.fullmatch("(s?(ua)+)?", roles):
                best = min(best or (cost, audit), (cost, audit))
    return best


def plain_best(turns):
    """Shortest path over the four states of the role pattern, whole audits compared."""
    go = {("E", "s"): "S", ("E", "u"): "U", ("S", "u"): "U", ("A", "u"): "U", ("U", "a"): "A"}

    def closed(now):
        todo = list(now)
        while todo:
            s = todo.pop()
            for x in "ua":
                if (s, x) in go:
                    new = (now[s][0] + 2, now[s][1] + "I", (*now[s][2], ("I", x)))
                    if go[s, x] not in now or new[:2] < now[go[s, x]][:2]:
                        now[go[s, x]] = new
                        todo.append(go[s, x])
        return now

    now = {"E": (0, "", ())}
    for initial, fault in turns:
        out = {}
        for s, (c, a, e) in closed(now).items():
            options = [(s, c + 3, "D", None)]
            if fault not in ("blank", "duplicate"):
                options += [(go[s, x], c + w + (fault == "truncated"), k, x) for k, w, x in [("K", 0, initial), ("R", 2, "u"), ("R", 2, "a")] if (s, x) in go]
            for t, cost, k, x in options:
                new = (cost, a + k, (*e, (k, x)))
                if t not in out or new[:2] < out[t][:2]:
                    out[t] = new
        now = out
    now = closed(now)
    return min((now[s] for s in "EA" if s in now), key=lambda x: x[:2])


def expected(rows, damaged=True):
    convs, ids = defaultdict(list), {r[0] for r in rows}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        what = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damaged else 9
        if what == 0:
            continue
        text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
        convs[conv] += [(turn, "user" if what == 4 else role, text)] * (2 if what == 3 else 1)
    out = {}
    for conv in ids:
        # turns of one number in these tests are alike or differ in nothing that counts
        own = sorted(convs[conv], key=lambda t: (t[0] is not None, t[0] or 0, t[1]))
        seen, turns, n = set(), [], defaultdict(int)
        for _, role, text in own:
            last = text.strip(SPACE)[-1:]
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else ""
            seen.add((role, text))
            turns.append((role[:1], fault))
            n[fault] += 1
        cost, audit, edits = plain_best(turns)
        kept, rest = [], iter(own)
        for k, x in edits:
            role, text = (None, "") if k == "I" else next(rest)[1:]
            if k != "D":
                kept.append(f"{dict(u='user', a='assistant')[x] if k in 'IR' else role}:{text}")
        numbers = [t for t, _, _ in own if t is not None]
        out[conv] = (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, n["blank"], n["duplicate"], n["truncated"],
                     sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:])), cost, audit,
                     hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def got_of(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


def test_plain_search_against_all_edits():
    for turns in itertools.product([("s", ""), ("u", ""), ("a", ""), ("a", "blank"), ("u", "truncated"), ("x", "")], repeat=2):
        assert plain_best(turns)[:2] == cheapest_of_all(turns)


@pytest.mark.parametrize("seed", range(6))
def test_parser_against_plain_search(seed):
    rng = random.Random(seed)
    for _ in range(300):
        turns = [(rng.choice("suuaax"), rng.choice(["", "", "", "blank", "duplicate", "truncated"])) for _ in range(rng.randint(0, 25))]
        start = R.tops()[0]
        now = {start.state: (0, "", start)}
        for i, f in turns:
            now = R.parse_turn(now, i, f in ("blank", "duplicate"), f == "truncated")
        got = min((c, a) for c, a, s in R.with_inserts(now).values() if R.advance(s, R.END))
        assert got == plain_best(turns)[:2]


def test_tops_are_four_and_every_pattern_parses():
    assert len(R.tops()) == 4
    for text in ["", "ua", "sua", "uaua", "suauaua"]:
        stacks = [R.tops()[0]]
        for x in text:
            stacks = [n for s in stacks for n in R.advance(s, x)]
        assert stacks and R.advance(stacks[0], R.END)
    for text in ["s", "u", "uau", "a", "ss", "usa"]:
        stacks = [R.tops()[0]]
        for x in text:
            stacks = [n for s in stacks for n in R.advance(s, x)]
        assert not any(R.advance(s, R.END) for s in stacks)


def query(spark, rows, tmp):
    from capset.llm.queries import QUERIES

    frame(spark, rows, SCHEMA).write.parquet(f"{tmp}/conversations.parquet")
    return got_of(QUERIES["op11_conversation_repair"](spark, tmp))


@pytest.mark.parametrize("bits", [10, 1])
def test_odd_tables(spark, tmp_dir, monkeypatch, bits):
    monkeypatch.setattr(R, "BLOCK_BITS", bits)  # blocks of two turns: every conversation is cut
    rng = random.Random(3)
    rows = []
    for c in [None, *range(40)]:
        for t in range(rng.randint(0, 14)):
            rows.append((c, rng.choice([t, t, t + 3]), rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]),
                         rng.choice(["Yes.", "No", "  ", "", None, "Why?", f"Text {t}.", "é\n"])))
    rows = list({(r[0], r[1]): r for r in rows}.values())  # one row a turn, so the order is given
    rows += [(77, None, "user", "Hi."), (77, None, "user", "Hi."), (78, 2**40, "user", "x" * 300_000 + "."), (78, 5, "system", "S!")]
    assert query(spark, rows, f"{tmp_dir}/{bits}") == expected(rows)


def test_empty_table_and_one_long_conversation(spark, tmp_dir, monkeypatch):
    assert query(spark, [], f"{tmp_dir}/none") == {}
    monkeypatch.setattr(R, "BLOCK_BITS", 6)
    rng = random.Random(9)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), rng.choice(["Same.", f"Text {t}", "Other?"])) for t in range(3000)]
    rows += [(2, 0, "user", "Hi."), (2, 1, "assistant", "Yes.")]
    assert query(spark, rows, f"{tmp_dir}/long") == expected(rows)


def test_edits_and_texts(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Yes"), (1, 3, "user", "And?")]
    report, edits = R.repair(frame(spark, rows, SCHEMA))
    assert report.drop("conv_id").first().asDict() == dict(gaps=0, blank=0, duplicate=1, truncated=1, illegal=1, cost=6, audit="KDKKI")
    got = [(r.edit, r.fault, r.turn, r.role, r.text) for r in edits.orderBy("place", "step").collect()]
    assert got == [("K", "", 0, "user", "Hi."), ("D", "duplicate", 1, "user", "Hi."), ("K", "truncated", 2, "assistant", "Yes"),
                   ("K", "", 3, "user", "And?"), ("I", "", None, "assistant", "")]


def test_query_against_plain_search(spark):
    from capset.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{SF01}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got_of(QUERIES["op11_conversation_repair"](spark, SF01)) == expected(rows)
