"""Sharding, conversation repair and the prefix trie: against plain programs, on rows with nulls, empty and very long
texts, ties, repeated rows, empty tables and columns with clashing names."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from moodtide.llm import conversation_repair as cr
from moodtide.llm import list_rank, prefix_trie, sharding
from moodtide.session import durable, scratch_path

CLASHING = "pos step edit initial fault present cost audit depth k1 k2 p1 p2 nid part h head id next leaves saved level n_chars _first".split()


def conversation_rows() -> list[tuple]:
    rng = random.Random(11)
    said = ["Hello there.", "What is it?", "no end", "", None, " \t\n", "Yes!", "No. ", "längeres Wort 😀.", "a ", "x." * 9000]
    rows = [
        (None, None, None, None), (None, 3, "user", "Hi."), (None, None, "system", "Be kind."), (1, 0, "user", None), (2, 5, None, "Text."),
        (3, 0, "user", "Same."), (3, 0, "user", "Same."), (3, 1, "", "No role."), (4, 9, "tool", "Out."), (4, None, "system", "First."),
        (200, 0, "user", "only one"),
    ]
    for conv in [*range(5, 40), *range(100, 130), 201, 299, 305, -3, -100, -105]:
        for turn in range(rng.randrange(1, 12)):
            if rng.random() < 0.9:
                rows.append((conv, turn if rng.random() < 0.95 else None, rng.choice(["user", "assistant", "assistant", "user", "system", None]), rng.choice(said)))
    return rows + [(conv, t, r, "Same everywhere.") for conv in range(400, 440) for t, r in ((0, "user"), (1, "assistant"))]


@pytest.fixture(scope="module")
def talk():
    return conversation_rows()


@pytest.fixture(scope="module")
def conversations(spark, talk):
    rows = spark.createDataFrame(talk, "conv_id bigint, turn bigint, role string, text string")
    return rows.selectExpr("*", *[f"'{name}' AS {name}" for name in CLASHING]).repartition(3)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# 11 conversation repair


def best_by_labels(initials, faults):
    """The cheapest edits by trying every edit of every label, state by state."""
    wanted, after = {0: "u", 1: "u", 2: "a", 3: "u"}, {"u": 2, "a": 3}

    def better(found, state, label):
        if state not in found or label < found[state]:
            found[state] = label

    def inserted(found):
        for _ in range(3):
            for state, (cost, audit) in list(found.items()):
                better(found, after[wanted[state]], (cost + 3, audit + "I"))
        return found

    labels = {0: (0, "")}
    for initial, fault in zip(initials, faults):
        following = {}
        for state, (cost, audit) in inserted(labels).items():
            better(following, state, (cost + 4, audit + "D"))
            if fault != cr.MUST_GO:
                extra = 3 * (fault == cr.CUT_OFF)
                better(following, after[wanted[state]], (cost + extra + 3, audit + "R"))
                if initial == wanted[state]:
                    better(following, after[initial], (cost + extra, audit + "K"))
                if initial == "s" and state == 0:
                    better(following, 1, (cost + extra, audit + "K"))
        labels = following
    ends = inserted(labels)
    return min(ends[s] for s in (0, 3) if s in ends)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("suax?"), st.sampled_from([0, 0, 1, 2])), max_size=24))
def test_search_finds_the_cheapest_edits(turns):
    initials, faults = "".join(t[0] for t in turns), bytes(t[1] for t in turns)
    assert cr.cheapest_edits(initials, faults) == best_by_labels(initials, faults)


@pytest.mark.parametrize("letters", ["ua", "sua", "s", "u", "a", "?", "sua?"])
def test_search_of_long_conversations(letters):
    rng = random.Random(letters)
    initials = "".join(rng.choice(letters) for _ in range(3000))
    faults = bytes(rng.choice([0, 0, 0, 1, 2]) for _ in range(3000))
    assert cr.cheapest_edits(initials, faults) == best_by_labels(initials, faults)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("sua"), st.sampled_from([0, 1, 2])), max_size=12))
def test_bounds_are_never_too_high(turns):
    initials, faults = "".join(t[0] for t in turns), bytes(t[1] for t in turns)
    for at, bound in enumerate(cr.suffix_bounds(initials, faults)):
        assert bound[0] <= best_by_labels(initials[at:], faults[at:])[0]


SPACES = " \t\n\x0b\x0c\r"


def plain_repair(rows):
    """What the query should return, conversation by conversation."""
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        held[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    found = {}
    for conv, turns in held.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        faults, seen, n = [], set(), Counter()
        for _, role, text in turns:
            fault = (
                "blank" if not text.strip(SPACES) else "duplicate" if (role, text) in seen
                else "truncated" if text.strip(SPACES)[-1] not in ".!?" else ""
            )
            seen.add((role, text))
            n[fault] += 1
            faults.append(cr.MUST_GO if fault in ("blank", "duplicate") else cr.CUT_OFF if fault else cr.SOUND)
        initials = "".join(r[:1] or "?" for _, r, _ in turns)
        cost, audit = best_by_labels(initials, faults)
        lines, at, place = [], 0, 0
        for edit in audit:
            if edit == "K":
                lines.append(f"{turns[at][1]}:{turns[at][2]}")
            elif edit != "D":
                lines.append(("user:", "assistant:")[place % 2] + (turns[at][2] if edit == "R" else ""))
            place += edit != "D" and not (edit == "K" and initials[at] == "s")
            at += edit != "I"
        numbers = [t for t, *_ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        found[conv] = (gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, sha("\n".join(lines)))
    return found


def repaired(conversations):
    report, turns = cr.repair(cr.damage(conversations))
    digests = {r["conv_id"]: r["repaired_sha256"] for r in cr.conversation_digests(turns).collect()}
    rows = report.collect()
    assert report.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: (*r[1:], digests.get(r["conv_id"], sha(""))) for r in rows}


def test_repair_matches_a_plain_program(conversations, talk):
    assert repaired(conversations) == plain_repair(talk)


def test_repair_of_nothing(conversations):
    report, turns = cr.repair(cr.damage(conversations.limit(0)))
    assert report.count() == 0 and turns.count() == 0 and cr.conversation_digests(turns).count() == 0


def test_one_conversation_may_hold_most_rows(spark):
    rows = [(7, i, "user" if i % 3 else "assistant", f"Turn {i % 900}.") for i in range(6000)] + [(8, 0, "user", "Hi.")]
    held = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    assert repaired(held) == plain_repair(rows)


# 12 sharding


def sharded(docs, **settings):
    return sorted((tuple(r) for r in sharding.shard_documents(docs, **settings).collect()), key=repr)


def test_shards_are_of_near_equal_bytes_and_numbered_without_gaps(messy, rows):
    found = sharding.shard_documents(messy, shards=6).collect()
    expected = Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == expected
    numbers, loads = defaultdict(list), Counter()
    for r in found:
        numbers[r["shard"]].append(r["slot"])
        loads[r["shard"]] += r["size"]
    assert set(numbers) <= set(range(6)) and all(sorted(n) == list(range(len(n))) for n in numbers.values())
    assert max(loads.values()) <= max(max(r["size"] for r in found), sum(loads.values()) / 6 * 1.05)


def test_shards_do_not_depend_on_partitions(spark, rows):
    hot = [(5, "the same row", "en", "a", 1)] * 300 + [(None, None, None, None, None)] * 200
    docs = spark.createDataFrame(rows + hot, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    first, second = sharded(docs.repartition(3)), sharded(docs.repartition(7, "text"))
    assert first == second
    loads = Counter(r[4] for r in first if r[0] == 5 and r[1] == 20)
    assert len(loads) >= 20 and max(loads.values()) < 40  # dealt over all shards but those that a long text fills


def test_rebalancing_edits_the_map(spark, tmp_path):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 50).cast("int")).alias("text"))
    kept = sharding.SlotMap(spark, scratch_path(spark, "map"))
    before = {r["doc_id"]: r["shard"] for r in sharding.shard_documents(docs, 8, slots=1000, slot_map=kept).collect()}
    sizes = sharding.slot_bytes(sharding.records_of(docs, 1000), 1000)
    assert kept.versions() == [1] and kept.rebalance(sizes, 9) == 2 and kept.versions() == [1, 2]
    after = {r["doc_id"]: r["shard"] for r in sharding.shard_documents(docs, 8, slots=1000, slot_map=kept).collect()}
    moved = [d for d in before if before[d] != after[d]]
    loads = Counter(after.values())
    assert set(loads) == set(range(9)) and max(loads.values()) < 1.1 * min(loads.values())
    assert len(moved) < 0.15 * len(before) and sum(after[d] == 8 for d in moved) > 0.9 * len(moved)
    assert kept.rebalance(sizes, 9) == 3  # nothing to move
    assert sorted(map(tuple, kept.read(2).collect())) == sorted(map(tuple, kept.read(3).collect()))
    assert kept.rebalance(sizes, 4) == 4 and {r["shard"] for r in kept.read().collect()} == set(range(4))
    assert {r["doc_id"]: r["shard"] for r in docs.limit(0).collect()} == {}


def test_written_shards_hold_whole_documents(spark, messy, rows):
    kept = sharding.SlotMap(spark, scratch_path(spark, "map"))
    placed = Counter((r["doc_id"], r["shard"]) for r in sharding.shard_documents(messy, 5, slot_map=kept).collect())
    path = scratch_path(spark, "shards")
    sharding.write_shards(messy, path, kept, files=2)
    written = spark.read.parquet(path)
    assert Counter((r["document"]["doc_id"], r["shard"]) for r in written.collect()) == placed
    whole = written.select("document.*")
    assert whole.columns == messy.columns and Counter(r["text"] for r in whole.collect()) == Counter(t for _, t, *_ in rows)


def test_sharding_nothing(nothing):
    assert sharding.shard_documents(nothing).count() == 0


# 13 prefix trie


def plain_trie(rows):
    """(conv_id, depth) -> the node's figures, from the sequences themselves."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role.encode())}:{role}:{text}".encode()).digest()
            own[conv].append((turn is not None, turn or 0, tie, role, text))
    members, ends = defaultdict(list), defaultdict(list)
    for conv in own:
        h = zlib.crc32(str(conv).encode()) % 6
        head = conv - (abs(conv) % 100) * (1 if conv >= 0 else -1)
        whole = [t[3:] for t in sorted(own.get(head, []))[:h]] + [t[3:] for t in sorted(own[conv])[h:]]
        for depth in range(len(whole) + 1):
            members[tuple(whole[:depth])].append(conv)
        ends[tuple(whole)].append(conv)
    children, leaves, saved = Counter(), Counter(), Counter()
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, inside in members.items():
        for depth in range(len(node) + 1):
            leaves[node[:depth]] += node not in children
            saved[node[:depth]] += (len(inside) - 1) * len(node[-1][1]) if node else 0
    return {
        (min(inside), len(node)): (
            min(members[node[:-1]]) if node else None, len(inside), children[node], leaves[node], saved[node], sha(",".join(map(str, sorted(ends[node]))))
        ) for node, inside in members.items()
    }


def nodes_of(trie):
    rows = trie.collect()
    found = {(r["conv_id"], r["depth"]): (r["parent_conv_id"], *r[3:]) for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("ranking", [{}, {"base": 8, "spacing": 3}])
def test_trie_matches_the_sequences(conversations, talk, ranking):
    assert nodes_of(prefix_trie.conversation_trie(conversations, **ranking)) == plain_trie(talk)


def test_trie_of_nothing(conversations):
    assert prefix_trie.conversation_trie(conversations.limit(0)).count() == 0
    assert prefix_trie.conversation_trie(conversations.filter("conv_id IS NULL")).count() == 0


@pytest.mark.parametrize("size", [1, 5, 700])
def test_list_rank(spark, size):
    rng = random.Random(size)
    ids = rng.sample(range(1 << 40), size)
    cuts = {0, *(rng.randrange(size) for _ in range(3))}  # several lists
    rows, expected, total = [], {}, (0, 0)
    for i in reversed(range(size)):
        last = i + 1 == size or i + 1 in cuts
        weight = (rng.randrange(100), rng.randrange(3))
        total = weight if last else (total[0] + weight[0], total[1] + weight[1])
        rows.append((ids[i], None if last else ids[i + 1], *weight))
        expected[ids[i]] = total
    rng.shuffle(rows)
    links = durable(spark.createDataFrame(rows, "id bigint, next bigint, a bigint, b bigint"))
    for settings in ({}, {"base": 4, "spacing": 4}):
        ranked = list_rank.suffix_sums(links, size, ("a", "b"), **settings)
        assert {r["id"]: (r["a"], r["b"]) for r in ranked.collect()} == expected
