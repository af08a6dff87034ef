"""The trie of conversations by their first turns, from adaptive radix trees over ranges of keys.

A turn's id is the first WIDTH bytes of a digest of its role and text, read as a
big-endian number, so a conversation's key is its turns' ids one after another
and keys in byte order keep all conversations of one beginning together. Keys
are sorted into ranges; a task builds an adaptive radix tree of one range (nodes
of 4, 16, 48 and 256 places that grow, paths without branches held as bytes) and
walks it: only byte depths that end a turn are nodes of the trie.

What a range can't know alone is about the beginnings that it shares with the
ranges beside it: the common beginning with the last key before and with the
first key after, one number each. All values of a node are sums over ranges (a
node counts itself where it begins first, and as a leaf where it ends last), so
shared nodes go through one aggregation, at most two paths for a range,
however many conversations a beginning has.

A conversation is one row; its key has WIDTH bytes a turn. A node's own digest
of the conversations that end there is taken from them in order, as they stream
by; ids of a node that several ranges share go on in chunks of CHUNK.

Defined cases: rows without a conv_id take no part; null role and text are
empty; turns are in order of turn (null first), then role, then the turn's id,
so repeated rows stay and ties are the same in every run; other columns are
ignored; no conversations, no nodes. Different turns of one id are as unlikely
as two equal numbers of 128 bits.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import kept, scratch, text_or_empty, written

WIDTH = 16
#: Turns of a range, and ids in a chunk.
RANGE_TURNS, CHUNK = 200_000, 512
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
#: kind: 0 whole node, 1 whole node below a shared one, 2 part of a shared node, 3 chunk of the ids that end at a shared node
MADE = f"kind int, part long, own binary, parent binary, {NODE}, chunk long"
_WHOLE, _BELOW, _PART, _ENDS = range(4)
_NONE = hashlib.sha256(b"").hexdigest()


# The tree of one range


class _Few:
    """Up to 16 places: sorted bytes beside their nodes; the layouts of 4 and 16."""

    __slots__ = ("room", "bytes", "nodes")

    def __init__(self, room: int = 4):
        self.room, self.bytes, self.nodes = room, bytearray(), []

    def get(self, byte: int):
        at = self.bytes.find(byte)
        return self.nodes[at] if at >= 0 else None

    def put(self, byte: int, node):
        """Adds a byte that isn't there yet, or replaces its node; gives the layout that holds it."""
        at = bisect_left(self.bytes, byte)
        if at < len(self.bytes) and self.bytes[at] == byte:
            self.nodes[at] = node
            return self
        if len(self.bytes) == self.room:
            return self._grown().put(byte, node)
        self.bytes.insert(at, byte)
        self.nodes.insert(at, node)
        return self

    def _grown(self):
        if self.room == 4:
            self.room = 16
            return self
        more = _Indexed()
        for byte, node in zip(self.bytes, self.nodes, strict=True):
            more.put(byte, node)
        return more

    def __iter__(self):
        return iter(self.nodes)


class _Indexed:
    """Up to 48 places: an index of 256 bytes into the nodes."""

    __slots__ = ("index", "nodes")

    def __init__(self):
        self.index, self.nodes = bytearray(256), []

    def get(self, byte: int):
        at = self.index[byte]
        return self.nodes[at - 1] if at else None

    def put(self, byte: int, node):
        if self.index[byte]:
            self.nodes[self.index[byte] - 1] = node
            return self
        if len(self.nodes) == 48:
            more = _Full()
            for b, at in enumerate(self.index):
                if at:
                    more.put(b, self.nodes[at - 1])
            return more.put(byte, node)
        self.nodes.append(node)
        self.index[byte] = len(self.nodes)
        return self

    def __iter__(self):
        return (self.nodes[at - 1] for at in self.index if at)


class _Full:
    """A place for every byte."""

    __slots__ = ("nodes",)

    def __init__(self):
        self.nodes = [None] * 256

    def get(self, byte: int):
        return self.nodes[byte]

    def put(self, byte: int, node):
        self.nodes[byte] = node
        return self

    def __iter__(self):
        return (n for n in self.nodes if n is not None)


class _Node:
    """The bytes since its parent's branch, the places below, and what ends here."""

    __slots__ = ("path", "below", "held")

    def __init__(self, path: bytes, held=None):
        self.path, self.below, self.held = path, None, held

    def put(self, byte: int, node: _Node) -> None:
        self.below = (self.below or _Few()).put(byte, node)


def _common(a: bytes, b: bytes) -> int:
    """How many bytes both begin with."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] == b[:low], a[:high] != b[:high]
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def inserted(root: _Node | None, key: bytes, held) -> _Node:
    """The tree with a key that it doesn't hold yet."""
    if root is None:
        return _Node(key, held)
    node, parent, branch, at = root, None, 0, 0
    while True:
        same = _common(node.path, key[at : at + len(node.path)])
        if same < len(node.path):  # the path splits
            above = _Node(node.path[:same])
            above.put(node.path[same], node)
            node.path = node.path[same + 1 :]
            if parent is None:
                root = above
            else:
                parent.put(branch, above)
            node = above
        at += same
        if at == len(key):
            node.held = held
            return root
        below = node.below.get(key[at]) if node.below else None
        if below is None:
            node.put(key[at], _Node(key[at + 1 :], held))
            return root
        parent, branch, node, at = node, key[at], below, at + 1


def _on_path(root: _Node, key: bytes) -> set[int]:
    """The nodes that lead to a key of the tree."""
    node, at, on = root, 0, set()
    while True:
        on.add(id(node))
        at += len(node.path)
        if at == len(key):
            return on
        node, at = node.below.get(key[at]), at + 1


def _digests(key: bytes, turns: int) -> list[bytes]:
    """Names of a key's beginnings of 0 to so many turns."""
    running, names = hashlib.sha256(), []
    for k in range(turns + 1):
        names.append(running.copy().digest()[:WIDTH])
        running.update(key[k * WIDTH : (k + 1) * WIDTH])
    return names


class _Held:
    """What ends at one key: how many conversations, the least of them, the sizes of its turns, and the digest or the chunks of their ids."""

    __slots__ = ("n", "least", "sizes", "digest", "chunks")

    def __init__(self, least: int, sizes, in_chunks: bool):
        self.n, self.least, self.sizes = 0, least, sizes
        self.digest, self.chunks = (None, []) if in_chunks else (hashlib.sha256(), None)

    def add(self, conv_id: int) -> None:
        if self.chunks is None:
            self.digest.update(f",{conv_id}".encode() if self.n else str(conv_id).encode())
        else:
            if self.n % CHUNK == 0:
                self.chunks.append([])
            self.chunks[-1].append(str(conv_id))
        self.n += 1

    def hexdigest(self) -> str:
        """The digest of a key that no other range shares."""
        digest = self.digest if self.chunks is None else hashlib.sha256(",".join(i for c in self.chunks for i in c).encode())
        return digest.hexdigest()


class _Range:
    """One range of sorted keys: shared says how many turns its first key has in common with the range before and its last with the one after, -1 for none."""

    def __init__(self, part: int, shared_before: int, shared_after: int):
        self.part, self.before, self.after = part, shared_before, shared_after
        self.root, self.first, self.key, self.held = None, None, None, None

    def add(self, conv_id: int, key: bytes, sizes) -> None:
        if key != self.key:
            self._settle()
            if self.first is None:
                self.first = key
            depth = len(key) // WIDTH
            # Only the first key and beginnings of the last can go on in other ranges, and which is the last shows at the end.
            self.key, self.held = key, _Held(conv_id, sizes, depth <= self.after or (key == self.first and depth <= self.before))
        self.held.add(conv_id)

    def _settle(self) -> None:
        """Puts the key whose conversations have all come into the tree."""
        if self.key is not None:
            self.root = inserted(self.root, self.key, self.held)

    def rows(self) -> Iterator[tuple]:
        """The rows of MADE."""
        self._settle()
        left, right = _on_path(self.root, self.first), _on_path(self.root, self.key)
        left_names, right_names = _digests(self.first, max(self.before, 0)), _digests(self.key, max(self.after, 0))
        done: list[tuple] = []
        # (node, byte depth where its path begins, place in the results of its parent, whether its children are done)
        todo = [(self.root, 0, None, False)]
        results: dict[int, list] = {}
        while todo:
            node, begin, parent, ready = todo.pop()
            if not ready:
                todo.append((node, begin, parent, True))
                for child in node.below or ():
                    todo.append((child, begin + len(node.path) + 1, id(node), False))
                continue
            end = begin + len(node.path)
            n, least, sizes, leaves, saved, new, pending = 0, None, None, 0, 0, 0, []
            for s in results.pop(id(node), ()):
                n += s[0]
                least = s[1] if least is None else min(least, s[1])
                sizes = s[2]
                leaves += s[3]
                saved += s[4]
                new += s[5]
                pending += s[6]
            ends = node.held
            if ends:
                n += ends.n
                least = ends.least if least is None else min(least, ends.least)
                sizes = ends.sizes if sizes is None else sizes
            below = bool(pending) or node.below is not None
            # The path covers the depths after the branch byte of its parent; the root's covers 0 too.
            floor = begin - 1 if parent is not None else -1
            for depth in range(end // WIDTH, floor // WIDTH, -1):
                with_before = id(node) in left and depth <= self.before
                with_after = id(node) in right and depth <= self.after
                own = int(sizes[depth - 1]) if depth else 0
                saved += own * (n if with_before else n - 1)
                leaves += not below and not with_after
                here = ends if depth * WIDTH == end else None
                name = left_names[depth] if with_before else right_names[depth] if with_after else None
                above = None if name is None or not depth else (left_names if with_before else right_names)[depth - 1]
                place = len(done)
                if name is not None:
                    done.append([_PART, self.part, name, above, least, depth, None, n, new, leaves, saved, None, None])
                    for k in pending:
                        if done[k][0] == _WHOLE:
                            done[k][0], done[k][3] = _BELOW, name
                    for k, chunk in enumerate(here.chunks if here else ()):
                        done.append([_ENDS, self.part, name, None, None, depth, None, None, None, None, None, ",".join(chunk), k])
                else:
                    done.append([_WHOLE, self.part, None, None, least, depth, None, n, new, leaves, saved, here.hexdigest() if here else _NONE, None])
                    for k in pending:
                        done[k][6] = least
                pending, new, below = [place], int(not with_before), True
            if parent is not None:
                results.setdefault(parent, []).append((n, least, sizes, leaves, saved, new, pending))
        return iter(map(tuple, done))


def _trees(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of MADE from sorted rows of ranges, one range at a time."""
    names = [c.split()[0] for c in MADE.split(", ")]
    current: _Range | None = None

    def frames():
        rows = list(current.rows())
        for k in range(0, len(rows), 1 << 15):
            frame = pd.DataFrame(rows[k : k + (1 << 15)], columns=names)
            yield frame.astype({c: "Int64" for c in names if c not in ("own", "parent", "ends_sha256")} | {"kind": "int32"})

    for batch in batches:
        for part, before, after, conv_id, key, sizes in batch.itertuples(index=False, name=None):
            if current is None or current.part != part:
                if current is not None:
                    yield from frames()
                current = _Range(part, before, after)
            current.add(conv_id, bytes(key), sizes)
    if current is not None:
        yield from frames()


def _digest_of_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One digest for each node from its chunks, as they stream by in order."""
    own, running = None, None
    for batch in batches:
        done = []
        for name, ids in zip(batch["own"], batch["ends_sha256"], strict=True):
            name = bytes(name)
            if name == own:
                running.update(b",")
            else:
                if own is not None:
                    done.append((own, running.hexdigest()))
                own, running = name, hashlib.sha256()
            running.update(ids.encode())
        yield pd.DataFrame(done, columns=["own", "ends"])
    if own is not None:
        yield pd.DataFrame([(own, running.hexdigest())], columns=["own", "ends"])


# On Spark


def turn_id(role: Column, text: Column) -> Column:
    """A turn's id as hexadecimal digits, WIDTH bytes; the role's length keeps role and text apart."""
    return F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * WIDTH)


def turns(rows: DataFrame) -> DataFrame:
    """Each conversation's turns in order: conv_id, turns (id, size in UTF-8 bytes)."""
    role, text = text_or_empty("role"), text_or_empty("text")
    slim = rows.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), F.struct("turn", role.alias("role"), turn_id(role, text).alias("id"), F.octet_length(text).alias("size")).alias("t"))
    return slim.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t["id"].alias("id"), t["size"].alias("size"))).alias("turns"))


def keyed(conversations: DataFrame) -> DataFrame:
    """conv_id, key, sizes of conversations with turns."""
    key = F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), ""))
    return conversations.select("conv_id", key.alias("key"), F.transform("turns", lambda t: t["size"]).alias("sizes"))


def _shared_turns(a: Column, b: Column) -> Column:
    """How many turns two keys both begin with."""
    n = F.least(F.length(a), F.length(b)) / WIDTH
    at = lambda key, k: F.substring(key, (k * WIDTH + 1).cast("int"), F.lit(WIDTH))
    places = F.when(n > 0, F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.coalesce(F.get(F.filter(places, lambda k: at(a, k) != at(b, k)), 0).cast("long"), n.cast("long"))


def trie(conversations: DataFrame, range_turns: int = RANGE_TURNS) -> DataFrame:
    """Every node of the trie of conversations (conv_id, turns) as a row of NODE: conv_id is the node's smallest member."""
    spark = conversations.sparkSession
    with scratch():
        keys = written(keyed(conversations), "keys")
        total = keys.agg(F.sum(F.size("sizes") + 1).alias("n")).first()["n"] or 0
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // range_turns), 1)
        ranged = written(keys.repartitionByRange(parts, "key", "conv_id").withColumn("part", F.spark_partition_id().cast("long")), "ranges")
        ends = written(ranged.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last")), "ends")
        # One number for each range that has rows.
        having = sorted(r["part"] for r in ends.select("part").collect())
        following = spark.createDataFrame(list(zip(having, [*having[1:], -1], strict=False)), "part long, next long")
        pairs = ends.join(following, "part").alias("a").join(ends.select(F.col("part").alias("next"), F.col("first").alias("other")), "next")
        common = written(pairs.select("part", "next", _shared_turns(F.col("last"), F.col("other")).alias("common")), "common")
        beside = ends.select("part").join(common.select("part", F.col("common").alias("after")), "part", "left")
        beside = beside.join(common.select(F.col("next").alias("part"), F.col("common").alias("before")), "part", "left")
        told = ranged.join(beside.select("part", F.coalesce("before", F.lit(-1)).alias("before"), F.coalesce("after", F.lit(-1)).alias("after")), "part")
        dealt = told.select("part", "before", "after", "conv_id", "key", "sizes").repartition(parts, "part").sortWithinPartitions("part", "key", "conv_id")
        made = written(dealt.mapInPandas(_trees, MADE), "nodes")
        columns = [c.split()[0] for c in NODE.split(", ")]
        whole = made.where(F.col("kind") == _WHOLE).select(*columns)
        shares = made.where(F.col("kind") == _PART)
        merged = shares.groupBy("own").agg(F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent").alias("parent"), *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")))
        merged = written(merged, "shared")
        # A node's chunks come in order of the range and the place in it, so memory is bounded; one digest is one sequence by its definition.
        chunks = made.where(F.col("kind") == _ENDS).select("own", "part", "chunk", "ends_sha256").repartition("own").sortWithinPartitions("own", "part", "chunk")
        digests = chunks.mapInPandas(_digest_of_chunks, "own binary, ends string")
        smallest = merged.select(F.col("own").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
        shared = merged.join(smallest, "parent", "left").join(digests, "own", "left").withColumn("ends_sha256", F.coalesce("ends", F.lit(_NONE))).select(*columns)
        # Below a shared node: by range and node, so that no key has more rows than a range.
        known = shares.select("part", "own").join(merged.select("own", "conv_id"), "own").select("part", F.col("own").alias("parent"), F.col("conv_id").alias("above"))
        below = made.where(F.col("kind") == _BELOW).drop("parent_conv_id").join(known, ["part", "parent"]).withColumnRenamed("above", "parent_conv_id").select(*columns)
        return kept(whole.unionByName(shared).unionByName(below), "trie")
