import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

import pytest

from tidegrid.llm import dialogue

SF_DIR = "/root/testdata/sf0.001"
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"


def damaged(rows):
    """Conversations after damage, by the contract's words: {conv_id: [(turn, role, text)]}."""
    found = {}
    for conv, turn, role, text in rows:
        shown = [" " if v is None else str(v) for v in (conv, turn)]
        role, text = (" " if v is None else v for v in (role, text))
        h = zlib.crc32(":".join(shown).encode()) % 20
        if h == 1:
            text = ""
        if h == 2:
            text = re.sub("[.!?]", "", text)
        if h == 4:
            role = "user"
        found.setdefault(conv, []).extend([(turn, role, text)] * {0: 0, 3: 2}.get(h, 1))
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    return {c: sorted(r, key=order) for c, r in found.items()}


def faults(turns):
    out, seen = [], set()
    for _, role, text in turns:
        visible = text.strip(WHITE)
        out.append("blank" if not visible else "duplicate" if (role, text) in seen
                   else "truncated" if visible[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(turns):
    """(cost, audit, roles and texts) by recursion from the end over whole strings."""
    kinds = faults(turns)

    @lru_cache(maxsize=None)
    def best(i, state, inserts):
        options = []
        if i == len(turns) and state in ("", "ua"):
            options.append((0, "", ()))
        onward = {"": "u", "s": "u", "u": "ua", "ua": "u"}[state]
        wanted = "assistant" if state == "u" else "user"
        if inserts < 3:
            c, e, r = best(i, onward, inserts + 1)
            options.append((c + 2, "I" + e, ((wanted, ""), *r)))
        if i < len(turns):
            _, role, text = turns[i]
            c, e, r = best(i + 1, state, 0)
            options.append((c + 3, "D" + e, r))
            if kinds[i] not in ("blank", "duplicate"):
                more = kinds[i] == "truncated"
                c, e, r = best(i + 1, onward, 0)
                options.append((c + 2 + more, "R" + e, ((wanted, text), *r)))
                if role[:1] == wanted[0]:
                    options.append((c + more, "K" + e, ((role, text), *r)))
                if role[:1] == "s" and state == "":
                    c, e, r = best(i + 1, "s", 0)
                    options.append((c + more, "K" + e, ((role, text), *r)))
        return min(options, default=(10**9, "~", ()))

    return best(0, "", 0)


def expected(rows):
    out = {}
    for conv, turns in damaged(rows).items():
        told = [t for t, _, _ in turns if t is not None]
        kinds = faults(turns)
        firsts = [role[:1] for _, role, _ in turns]
        cost, audit, kept = cheapest(turns)
        out[conv] = {
            "conv_id": conv,
            "gaps": max(told) - min(told) + 1 - len(set(told)) if told else 0,
            **{k: kinds.count(k) for k in ("blank", "duplicate", "truncated")},
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:])),
            "cost": cost,
            "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest(),
        }
    return out


def table_of(spark, rows):
    return spark.createDataFrame(
        [(*r, "x", 0) for r in rows], "conv_id long, turn long, role string, text string, audit string, present2 int")


def repaired(spark, rows, **limits):
    turns = spark.sql(dialogue.DAMAGED, rows=table_of(spark, rows)).drop("copy")
    return {r["conv_id"]: r.asDict() for r in dialogue.digests(dialogue.repair(turns, **limits)).collect()}


def random_rows(rnd, convs, most):
    rows = []
    for conv in range(convs):
        for turn in range(rnd.randint(1, most)):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "usher", "", None])
            text = rnd.choice(["Yes.", "So it is!", "cut off", " \t", "", "Really?  ", None, f"Turn {turn}.", f"é{turn} \xa0"])
            rows.append((conv, rnd.choice([turn, turn, turn + 2, None]), role, text))
    return rows


def test_classes_against_all_edit_scripts():
    roles = {0: "t", 1: "s", 2: "u", 3: "a"}
    kinds = [3 * i + f for i in range(4) for f in range(3)]
    rnd = random.Random(0)
    cases = [c for n in range(3) for c in itertools.product(kinds, repeat=n)]
    cases += [tuple(rnd.choice(kinds) for _ in range(3)) for _ in range(60)]
    for case in cases:
        best = None
        edits = [["D"] if c % 3 == 2 else ["D", "K", "Ru", "Ra"] for c in case]
        inserts = ["", "u", "a", "ua", "au"]
        for chosen in itertools.product(*edits):
            for around in itertools.product(inserts, repeat=len(case) + 1):
                cost, audit, initials = 2 * len(around[0]), "I" * len(around[0]), around[0]
                for c, e, more in zip(case, chosen, around[1:]):
                    cost += {"D": 3, "K": 0}.get(e, 2) + (c % 3 == 1 and e != "D") + 2 * len(more)
                    audit += e[0] + "I" * len(more)
                    initials += (roles[c // 3] if e == "K" else "" if e == "D" else e[1]) + more
                if re.fullmatch("(s?(ua)+)?", initials) and (best is None or (cost, audit) < best):
                    best = (cost, audit)
        assert dialogue.whole(bytes(case)) == best, case


@pytest.mark.parametrize("seed", range(3))
def test_folded_segments_equal_the_whole(seed):
    rnd = random.Random(seed)
    for _ in range(300):
        classes = bytes(rnd.choice([0, 1, 3, 4, 6, 6, 7, 8, 9, 9, 10, 11]) for _ in range(rnd.randint(1, 30)))
        step = rnd.randint(1, 6)
        parts = [dialogue.between(classes[i : i + step]) for i in range(0, len(classes), step)]
        chosen = dialogue.fold([(c, r) for c, r, _ in parts])
        audit = "".join(p[2][4 * q + r] + end for p, (q, r, _, end) in zip(parts, chosen))
        assert (sum(c for _, _, c, _ in chosen), audit) == dialogue.whole(classes)


def test_common_prefixes_and_collisions(monkeypatch):
    rnd = random.Random(1)
    monkeypatch.setattr(dialogue, "BASE", 1)  # any order of the same letters collides
    tree, texts = dialogue.Prefixes(), {0: ""}
    for _ in range(1500):
        tail = rnd.choice(list(texts)[-40:])
        letter = rnd.choice("DIK")
        texts[tree.add(tail, letter)] = texts[tail] + letter
    nodes = list(texts)
    for _ in range(4000):
        a, b = rnd.choice(nodes), rnd.choice(nodes)
        assert tree.text(a) == texts[a]
        assert tree.less(a, b) == (texts[a] < texts[b])
        if len(texts[a]) == len(texts[b]):
            assert tree.equal(a, b) == (texts[a] == texts[b])


def test_random_conversations_whole_and_in_segments(spark):
    rnd = random.Random(2)
    rows = random_rows(rnd, 120, 25) + [(None, 1, "user", "Hi."), (None, None, None, None), (7, 3, "user", "Yes.")]
    wanted = expected(rows)
    assert repaired(spark, rows) == wanted
    assert repaired(spark, rows, segment_rows=4) == wanted
    assert repaired(spark, rows, segment_rows=1000, segment_bytes=40) == wanted


def test_one_conversation_with_most_rows(spark):
    rnd = random.Random(5)
    rows = [(1, i, rnd.choice(["user", "assistant"]), rnd.choice(["Yes.", f"No {i}.", "cut"])) for i in range(3000)]
    rows += [(2, i, "user", "Well.") for i in range(3)]
    turns = spark.sql(dialogue.DAMAGED, rows=table_of(spark, rows)).drop("copy")
    parts = dialogue.repair(turns, segment_rows=100).filter("conv_id = 1").collect()
    assert len(parts) > 25 and max(r["n_rows"] for r in parts) <= 100
    got = repaired(spark, rows, segment_rows=100)
    assert got == repaired(spark, rows)
    assert got[1]["duplicate"] == faults(damaged(rows)[1]).count("duplicate")


def test_edges(spark):
    dropped = next(i for i in range(100) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = repaired(spark, [(dropped, 0, "user", "Gone.")])
    assert got == expected([(dropped, 0, "user", "Gone.")])
    assert got[dropped]["audit"] == "" and got[dropped]["repaired_sha256"] == hashlib.sha256(b"").hexdigest()
    assert repaired(spark, []) == {}
    long = [(5, i, r, "word " * 200_000 + ".") for i, r in enumerate(["user", "assistant", "user"])]
    assert repaired(spark, long) == expected(long)


def test_query_on_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").collect()]
    got = dialogue.op12(spark, SF_DIR)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r["conv_id"]: r.asDict() for r in got.collect()} == expected(rows)


def test_turns_after_repair(spark):
    turns = spark.createDataFrame(
        [(1, 1, "assistant", "Hello."), (1, 2, "user", "Hi"), (1, 3, "user", "Hi")],
        "conv_id long, turn int, role string, text string")
    row = dialogue.repair(turns).first()
    assert (row["cost"], row["audit"], row["duplicate"], row["truncated"]) == (8, "IKDD", 1, 1)
    kept = [t["role"][0] for t in row["turns"] if t["edit"] != "D"]
    assert re.fullmatch("(s?(ua)+)?", "".join(kept))
    assert [t["edit"] for t in row["turns"]] == list(row["audit"])
