"""Conversation prefix trie: which beginnings conversations share, and what that saves.

A rebuilt conversation begins with the head of another one and goes on with turns of
its own. No rebuilt text is made. Each turn is an affine map of two 64-bit rings, the
fingerprint of a sequence of turns is the product of their maps, and products compose:
the one of a rebuilt beginning is the product of the base's head times that of the own
turns, and a run of turns inside a conversation is one prefix product over another,
since each map has an inverse.

A node is a depth and a fingerprint. Its members must refer to one and the same last
turn; as the map of that turn can be undone, they then have the same parent too, so by
induction a node's members have equal turns if equal turn keys mean equal turns. Both
are checked on all rows, the latter on the texts; should either fail, another seed is
taken. Texts themselves are never shuffled but for that check.

Sums over subtrees need no walk over levels. Each conversation owns the nodes of which
it is the smallest member; these are the lower end of its path. What it has in
common with smaller ones it has above, and sums over members of a node are sums over
its subtree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispark.llm.common import join_groups, small_side
from lexispark.llm.text import mix
from lexispark.scale import materialize

GROUP = 5  # a conversation takes its head from the one whose id is next below, divisible by this
HEAD = 9  # heads are shorter than this
ID_BITS = 12  # so many bits of an id lie within one text of ids
LONG_TURNS = 100_000  # a longer conversation is split over tasks
SEEDS = 8  # tries before a check that keeps failing is an error
NODE = ("depth", "f1", "f2")

_U = np.uint64
_COLUMNS = ("base", "conv", "head", "k1", "k2", "bytes")
_MEMBER = ("conv_id bigint, depth bigint, f1 bigint, f2 bigint, k1 bigint, k2 bigint, "
           "bytes bigint, path_bytes bigint, ended boolean")


def _inverse(a: np.ndarray) -> np.ndarray:
    """Of odd numbers modulo 2**64."""
    x = (a * _U(3)) ^ _U(2)
    for _ in range(4):
        x = x * (_U(2) - a * x)
    return x


class Products:
    """Prefix products of the affine maps x -> a*x + b of a row of turns."""

    def __init__(self, a: np.ndarray, b: np.ndarray):
        one, none = np.ones(1, np.uint64), np.zeros(1, np.uint64)
        self.a = np.concatenate((one, np.cumprod(a, dtype=np.uint64)))
        self.back = _inverse(self.a)
        self.b = self.a * np.concatenate((none, np.cumsum(b * self.back[1:], dtype=np.uint64)))

    def run(self, start, end):
        """The map of the turns start .. end - 1."""
        a = self.a[end] * self.back[start]
        return a, self.b[end] - a * self.b[start]


def maps(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The map of each turn, from its key."""
    return mix(keys ^ _U(0xA0761D6478BD642F)) | _U(1), mix(keys ^ _U(0xE7037ED1A0B428DB))


class _Block:
    """Rows of turns sorted by base and conversation, the base first: what earlier
    blocks leave behind, then a batch. ``weight`` is the number of turns a row stands
    for; rows with ``new`` unset are known already."""

    NAMES = (*_COLUMNS, "weight", "new", "a1", "b1", "a2", "b2")

    def __init__(self, columns: dict[str, np.ndarray]):
        self.columns = columns

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> _Block:
        return cls.from_arrays({n: batch.column(i).to_numpy(zero_copy_only=False)
                                for i, n in enumerate(_COLUMNS)})

    @classmethod
    def from_arrays(cls, got: dict[str, np.ndarray]) -> _Block:
        for n in "12":
            got["k" + n] = got["k" + n].view(np.uint64)
            got["a" + n], got["b" + n] = maps(got["k" + n])
        rows = len(got["conv"])
        return cls(got | {"weight": np.ones(rows, np.int64), "new": np.ones(rows, bool)})

    def after(self, kept: _Block | None) -> _Block:
        if kept is None:
            return self
        return _Block({n: np.concatenate((kept.columns[n], self.columns[n]))
                       for n in self.NAMES})

    def members(self, following: int | None, done: int | None):
        """Member rows of the new turns, and what the next block needs: its known
        rows and the base that has been dealt with. ``following`` is the next
        conversation after this block."""
        c = self.columns
        conv, base, rows = c["conv"], c["base"], len(c["conv"])
        cut = np.flatnonzero(np.diff(conv) != 0) + 1
        start, end = np.concatenate(([0], cut)), np.concatenate((cut, [rows]))
        ids, group, head = conv[start], base[start], c["head"][start]
        turns = np.add.reduceat(c["weight"], start)
        count = np.cumsum(c["weight"])
        seg = np.repeat(np.arange(len(start)), end - start)
        place = count - np.repeat(count[start] - c["weight"][start], end - start)
        over = np.ones(len(start), bool)
        over[-1] = following != ids[-1]
        # the first conversation of a group is its base, if that exists
        lead = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        lead = lead[np.cumsum(np.isin(np.arange(len(start)), lead)) - 1]
        origin = start[lead]
        taken = np.where(ids[lead] == group, np.minimum(head, turns[lead]), 0)
        size = np.concatenate(([0], np.cumsum(c["bytes"])))
        one, two = (Products(c["a" + n], c["b" + n]) for n in "12")

        at = np.flatnonzero(c["new"] & (place > head[seg]))
        s = seg[at]
        prints = []
        for p in (one, two):
            _, first = p.run(origin[s], origin[s] + taken[s])
            a, b = p.run(start[s] + head[s], at + 1)
            prints.append(a * first + b)
        own_start = start[s] + head[s]
        own = (conv[at], taken[s] + place[at] - head[s], *prints, c["k1"][at], c["k2"][at],
               c["bytes"][at],
               size[origin[s] + taken[s]] - size[origin[s]] + size[at + 1] - size[own_start],
               (at + 1 == end[s]) & over[s])

        closed = np.flatnonzero(over & ~((ids == done) if done is not None else False))
        s = np.repeat(closed, taken[closed] + 1)
        first = np.cumsum(taken[closed] + 1) - (taken[closed] + 1)
        depth = np.arange(len(s)) - np.repeat(first, taken[closed] + 1)
        last = np.maximum(origin[s] + depth - 1, 0)
        begun = (ids[s], depth,
                 one.run(origin[s], origin[s] + depth)[1], two.run(origin[s], origin[s] + depth)[1],
                 *(np.where(depth > 0, c[n][last], 0).astype(c[n].dtype)
                   for n in ("k1", "k2", "bytes")),
                 size[origin[s] + depth] - size[origin[s]],
                 (depth == taken[s]) & (turns[s] <= head[s]))
        arrays = [np.concatenate(pair) for pair in zip(own, begun, strict=True)]
        out = pa.RecordBatch.from_arrays(
            [pa.array(x.view(np.int64) if x.dtype == np.uint64 else x) for x in arrays],
            [part.split()[0] for part in _MEMBER.split(", ")])
        return out, *self.tail(following == ids[-1])

    def tail(self, goes_on: bool):
        """The rows by which a later block knows what was here, all known by then: the first
        turns of the last group's base, and of a last conversation that goes on its first
        turns and all others as one row. With them the base, if it has ended."""
        c = self.columns
        start = np.flatnonzero(np.diff(c["conv"], prepend=c["conv"][0] - 1) != 0)
        end = np.append(start[1:], len(c["conv"]))
        lead = int(np.searchsorted(start, np.flatnonzero(c["base"] == c["base"][-1])[0]))
        last = len(start) - 1
        base = int(c["conv"][start[lead]])
        has_base = base == c["base"][-1]
        wanted = ([lead] if has_base else []) + (
            [last] if goes_on and not (has_base and lead == last) else [])
        if not wanted:
            return None, None
        pick = np.concatenate([np.arange(start[i], min(end[i], start[i] + HEAD)) for i in wanted])
        kept = {n: c[n][pick] for n in self.NAMES}
        begin = start[last] + HEAD
        if goes_on and end[last] > begin:
            rest = slice(begin, end[last])
            row = {n: c[n][begin] for n in ("base", "conv", "head", "k1", "k2")}
            row |= {n: c[n][rest].sum() for n in ("bytes", "weight")}
            for n in "12":
                a, b = Products(c["a" + n], c["b" + n]).run(*np.array([[begin], [end[last]]]))
                row |= {"a" + n: a[0], "b" + n: b[0]}
            kept = {n: np.append(kept[n], np.array([row.get(n, 0)], kept[n].dtype))
                    for n in self.NAMES}
        kept["new"] = np.zeros(len(kept["new"]), bool)
        return _Block(kept), base if has_base and not (goes_on and lead == last) else None


def _member_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per node a conversation passes, from turns sorted by base, base first,
    conversation and turn. Memory is that of a batch, however long conversations are."""
    kept = done = waiting = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        block = _Block.of(batch)
        if waiting is not None:
            out, kept, done = waiting.after(kept).members(int(block.columns["conv"][0]), done)
            yield out
        waiting = block
    if waiting is not None:
        yield waiting.after(kept).members(None, done)[0]


def _turns(conversations: DataFrame, seed: int) -> DataFrame:
    role, text = (F.coalesce(F.col(n), F.lit("")).alias(n) for n in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role, text)
    key = (F.length("role"), F.col("role"), F.col("text"))
    return turns.withColumns({
        "k1": F.xxhash64(F.lit(2 * seed), *key), "k2": F.xxhash64(F.lit(2 * seed + 1), *key)})


def _keys_are_sound(turns: DataFrame) -> bool:
    """Whether turns of one key are equal, on the texts of all keys that occur twice."""
    again = materialize(
        turns.groupBy("k1", "k2").agg(F.count("*").alias("n")).where("n > 1").drop("n"),
        "trie-repeated")
    same = turns.join(small_side(again), ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(
        *[f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("role", "text")])
    return same.where("min_role <> max_role or min_text <> max_text").isEmpty()


def _members(turns: DataFrame, group: int, head: int) -> DataFrame:
    base = F.col("conv_id") - F.col("conv_id") % group
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % head
    steps = turns.select(
        base.alias("base"), F.col("conv_id").alias("conv"), taken.cast("int").alias("head"),
        "k1", "k2", F.octet_length("text").cast("bigint").alias("bytes"), "turn")
    order = ("base", F.col("conv") != F.col("base"), "conv", F.asc_nulls_first("turn"), "k1", "k2")
    long = materialize(
        steps.groupBy("base", "conv").count().where(F.col("count") > LONG_TURNS)
        .select("base").distinct(), "trie-long")
    split = not long.isEmpty()
    rest = steps.join(small_side(long), "base", "left_anti") if split else steps
    members = rest.repartition("base").sortWithinPartitions(*order).select(*_COLUMNS).mapInArrow(
        _member_rows, _MEMBER)
    if split:
        some = steps.join(small_side(long), "base", "left_semi").withColumn(
            "other", F.col("conv") != F.col("base"))
        order = ("base", "other", "conv", F.asc_nulls_first("turn"), "k1", "k2")
        members = members.union(_long_members(
            some.repartitionByRange(*order).sortWithinPartitions(*order).select(*_COLUMNS)))
    return materialize(members, "trie-members")


# --- conversations too long for one task

_CHUNK = ("base bigint, part int, chunk int, conv array<bigint>, head array<int>, "
          "k1 array<bigint>, k2 array<bigint>, bytes array<bigint>")
_TAIL = ("base bigint, part int, chunk int, first bigint, " + ", ".join(
    f"t_{n} array<{'int' if n == 'head' else 'bigint'}>"
    for n in _Block.NAMES if n not in ("base", "new")))
_CARRY = (_TAIL.replace("base bigint, ", "").replace("first bigint", "following bigint, done bigint")
          + ", t_base bigint")
_TAILS = [n for n in _Block.NAMES if n not in ("base", "new")]


def _long_members(steps: DataFrame) -> DataFrame:
    """Member rows of sorted turns that were dealt out by range, so that one conversation may
    lie in many partitions. They become rows of so many turns as a batch has; what each leaves
    to the next is small and is summed up in order, and then all are solved on their own."""
    chunks = materialize(steps.mapInArrow(_chunk_rows, _CHUNK), "trie-chunks")
    tails = chunks.mapInArrow(_chunk_tails, _TAIL)
    carries = tails.repartition("base").sortWithinPartitions("base", "part", "chunk").mapInArrow(
        _carried, _CARRY)
    joined = chunks.join(materialize(carries, "trie-carries"), ["part", "chunk"])
    return joined.mapInArrow(_chunk_members, _MEMBER)


def _chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, chunk = TaskContext.get().partitionId(), 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        base = batch.column(0).to_numpy()
        at = np.append(np.flatnonzero(np.diff(base, prepend=base[0] - 1) != 0), len(base))
        n = len(at) - 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(base[at[:-1]]), pa.array([part] * n, pa.int32()),
             pa.array(np.arange(chunk, chunk + n), pa.int32()),
             *(pa.ListArray.from_arrays(pa.array(at, pa.int32()), batch.column(i))
               for i in range(1, len(_COLUMNS)))],
            [c.split()[0] for c in _CHUNK.split(", ")])
        chunk += n


def _chunk_block(row: dict) -> _Block:
    arrays = {n: np.array(row[n], np.int32 if n == "head" else np.int64) for n in _COLUMNS[1:]}
    return _Block.from_arrays(arrays | {"base": np.full(len(row["conv"]), row["base"], np.int64)})


def _tail_lists(block: _Block | None) -> dict:
    return {f"t_{n}": None if block is None else block.columns[n].view(
        np.int32 if n == "head" else np.int64).tolist() for n in _TAILS}


def _tail_block(row: dict, base: int) -> _Block | None:
    if row["t_conv"] is None:
        return None
    kinds = {"head": np.int32} | dict.fromkeys(("k1", "k2", "a1", "b1", "a2", "b2"), np.uint64)
    got = {n: np.array(row[f"t_{n}"], np.int32 if n == "head" else np.int64).view(
        kinds.get(n, np.int64)) for n in _TAILS}
    rows = len(got["conv"])
    return _Block(got | {"base": np.full(rows, base, np.int64), "new": np.zeros(rows, bool)})


def _table(rows: list[dict], schema: str) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "array<bigint>": pa.list_(pa.int64()),
             "array<int>": pa.list_(pa.int32())}
    columns = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[n] for r in rows], kinds[k]) for n, k in columns], [n for n, _ in columns])


def _chunk_tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            block = _chunk_block(row)
            yield _table([{**row, "first": row["conv"][0], **_tail_lists(block.tail(True)[0])}], _TAIL)


def _carried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each chunk what the earlier ones of its base leave, and who follows. The tail of
    tails is the tail of the turns they stand for."""
    kept = done = waiting = None

    def told(row, following):
        return _table([{**row, "following": following, "done": done, "t_base": row["base"],
                        **_tail_lists(kept)}], _CARRY)

    for batch in batches:
        for row in batch.to_pylist():
            if waiting is not None:
                same = waiting["base"] == row["base"]
                yield told(waiting, row["first"] if same else None)
                kept, done = (_tail_block(waiting, waiting["base"]).after(kept).tail(
                    row["first"] == waiting["t_conv"][-1])) if same else (None, None)
            waiting = row
    if waiting is not None:
        yield told(waiting, None)


def _chunk_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            block = _chunk_block(row).after(_tail_block(row, row["t_base"]))
            yield block.members(row["following"], row["done"])[0]


def _owners(members: DataFrame) -> tuple[DataFrame, bool]:
    """What each conversation owns: the depth of its first own node, the bytes above
    that, and whether its end is a leaf; and whether every node has one last turn."""
    nodes = members.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n"),
        F.sum(F.col("ended").cast("int")).alias("n_ends"),
        F.min(F.col("path_bytes") - F.col("bytes")).alias("above"),
        F.max(F.col("path_bytes") - F.col("bytes")).alias("above_max"),
        *[f(k).alias(f"{f.__name__}_{k}") for f in (F.min, F.max) for k in ("k1", "k2")])
    sound = (F.col("min_k1") == F.col("max_k1")) & (F.col("min_k2") == F.col("max_k2")) & (
        F.col("above") == F.col("above_max"))
    owned = materialize(nodes.groupBy("conv_id").agg(
        F.min("depth").alias("own"), F.min("above").alias("above"),
        F.max(F.col("n") == F.col("n_ends")).alias("leaf"), F.min(sound).alias("sound")),
        "trie-owned")
    ends = members.where("ended").select(
        "conv_id", F.col("depth").alias("length"), F.col("path_bytes").alias("total"))
    owners = ends.join(owned.drop("sound"), "conv_id", "left").select(
        "conv_id", "length",
        F.coalesce("own", F.col("length") + 1).alias("own"),
        F.coalesce("above", "total").alias("above"),
        F.coalesce("leaf", F.lit(False)).alias("leaf"))
    return materialize(owners, "trie-owners"), owned.where("not sound").isEmpty()


def _ends(members: DataFrame) -> DataFrame:
    """For each node at which conversations end, the digest of their ids. Ids are first
    joined to texts of up to 2**ID_BITS of them, then digested in order, a text at a time."""
    texts = members.where("ended").groupBy(
        *NODE, F.shiftright("conv_id", ID_BITS).alias("part")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",")
        .alias("ids"))
    dealt = texts.repartition(*NODE).sortWithinPartitions(*NODE, "part")

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(finished):
            return pa.RecordBatch.from_arrays(
                [*(pa.array([node[i] for node, _ in finished], pa.int64()) for i in range(3)),
                 pa.array([d.hexdigest() for _, d in finished], pa.string())],
                [*NODE, "ends_sha256"])

        node = digest = None
        for batch in batches:
            finished = []
            nodes = zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
            for one, ids in zip(nodes, batch.column(4).to_pylist(), strict=True):
                if one == node:
                    digest.update(b"," + ids.encode())
                else:
                    if node is not None:
                        finished.append((node, digest))
                    node, digest = one, hashlib.sha256(ids.encode())
            yield rows(finished)
        if node is not None:
            yield rows([(node, digest)])

    return dealt.mapInArrow(
        digested, "depth bigint, f1 bigint, f2 bigint, ends_sha256 string")


def _summed(members: DataFrame, owners: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All nodes with their sums, and (conv_id, depth, parent) of each first own node."""
    seen = members.join(small_side(owners), "conv_id")
    child = (F.col("own") <= F.col("depth") + 1) & (F.col("depth") < F.col("length"))
    saved = F.when(F.col("depth") < F.col("own"),
                   F.col("above") - F.col("path_bytes") + F.col("bytes")).otherwise(0)
    nodes = materialize(seen.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
        F.sum(child.cast("bigint")).alias("n_children"),
        F.sum(F.col("leaf").cast("bigint")).alias("n_leaves"),
        F.sum(saved).alias("saved_tokens")), "trie-nodes")
    key = F.concat_ws(":", *NODE)
    tops = seen.where("depth = own - 1").select("conv_id", "own", key.alias("node"))
    tops = materialize(tops, "trie-tops")
    parents = materialize(nodes.where("n_children > 0").select(
        key.alias("node"), F.col("conv_id").alias("parent_conv_id"), "n_children"), "trie-parents")
    found = join_groups(tops, parents, "node", "n_children", F.col("conv_id").cast("string"))
    return nodes, found.select("conv_id", F.col("own").alias("depth"), "parent_conv_id")


def prefix_trie(conversations: DataFrame, group: int = GROUP, head: int = HEAD) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: conv_id (the smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (the
    bytes that further members repeat in the subtree) and ends_sha256 (of the ids of
    the members that end here).

    ``conversations`` has conv_id, turn, role and text; other columns are ignored. Turns
    are ordered by ``turn``, null first, and by a hash of their content where it ties,
    so repeated rows are turns of their own. A null role or text is empty. Rows without
    a conv_id belong to no conversation and are left out; an empty table has no node.
    Each id c is rebuilt from the first crc32(c) % ``head`` turns of c - c % ``group``
    and from its own after as many. Texts of any length count; none is shuffled except
    repeated ones, once per task, to be compared. Conversations of over ``LONG_TURNS`` turns
    are split over tasks.
    """
    if head > HEAD:
        raise ValueError(f"heads of up to {HEAD - 1} turns")
    for seed in range(SEEDS):
        turns = _turns(conversations, seed)
        if not _keys_are_sound(turns):
            continue
        members = _members(turns, group, head)
        owners, sound = _owners(members)
        if sound:
            break
    else:
        raise RuntimeError("no seed tells all turns apart")
    nodes, tops = _summed(members, owners)
    none = hashlib.sha256(b"").hexdigest()
    parent = F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "conv_id"))
    return nodes.join(_ends(members), [*NODE], "left").join(
        tops, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))
