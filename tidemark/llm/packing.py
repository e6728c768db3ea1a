"""Best-fit packing of token pieces into sequences by a grouping genetic algorithm.

Pieces are dealt to shards of bounded size at random. In each shard several islands, tasks of their
own, start from best-fit packings and breed: crossover takes whole well-filled bins of one
parent into another, takes out the bins that hold any of their pieces, and puts displaced pieces
where they fit best. Then the islands' elites meet: their best packings are parents of a last
population per shard. Full bins stay; the pieces of the others are dealt to new, fewer shards and
packed again, so that the loss at the edges of shards is packed away.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.base import documents, fields, query, renamed, stored
from tidemark.llm.encode import batches_of, encoder

CAPACITY = 4096
# Pieces of a shard (on average); what one task packs at once.
SHARD_PIECES = 4096
ISLANDS = 2
GENERATIONS = 6
POPULATION = 4
ROUNDS = 3
END = 1

PIECES = fields(doc_id="long", piece="int", start="long", length="long", ids_crc32="long")
# Pieces by a stored number, so that repeated rows are dealt out like others.
_ROWS = T.StructType([*PIECES, *fields(row="long")])


def token_pieces(
    docs: DataFrame, vocabulary: str, *, kind: str = "word", end: int = END, capacity: int = CAPACITY, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Tokens of every whole text and its end id, cut into pieces of ``capacity`` ids."""

    def cut(batches):
        encode = encoder(vocabulary, kind, end).encode
        for batch in batches:
            names, texts = batch.column(0), batch.column(1).to_pylist()
            for low, high in batches_of(texts):
                ids, offsets = encode(texts[low:high])
                ids, lengths = ids.astype("<u4", copy=False), np.diff(offsets)
                counts = -(-lengths // capacity)
                owner = np.repeat(np.arange(high - low), counts)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
                starts = piece * capacity
                sizes = np.minimum(lengths[owner] - starts, capacity)
                at = offsets[owner] + starts
                sums = [zlib.crc32(ids[a : a + n].tobytes()) for a, n in zip(at, sizes)]
                columns = [names.take(pa.array(owner + low)), pa.array(piece.astype(np.int32)), pa.array(starts), pa.array(sizes), pa.array(sums, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=PIECES.names)

    rows = renamed(docs, doc_id=id_column, text=text_column)
    return rows.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


class Packing:
    """Bins of piece numbers, with their free room kept in order for best fit."""

    def __init__(self, sizes: np.ndarray, capacity: int) -> None:
        self.sizes, self.capacity = sizes, capacity
        self.bins: dict[int, list[int]] = {}
        self.free: dict[int, int] = {}
        self.order: list[tuple[int, int]] = []
        self.next = 0

    def add(self, pieces: list[int], room: int) -> None:
        self.bins[self.next], self.free[self.next] = pieces, room
        insort(self.order, (room, self.next))
        self.next += 1

    def insert(self, piece: int) -> None:
        """Into the bin whose room it leaves least of, or a new one."""
        size = self.sizes[piece]
        at = bisect_left(self.order, (size, -1))
        if at == len(self.order):
            self.add([piece], self.capacity - size)
            return
        room, name = self.order.pop(at)
        self.bins[name].append(piece)
        self.free[name] = room - size
        insort(self.order, (room - size, name))

    def fill(self, pieces) -> Packing:
        """Insert pieces, the largest first."""
        for piece in sorted(pieces, key=lambda p: (-self.sizes[p], p)):
            self.insert(piece)
        return self

    def without(self, taken: set[int]) -> tuple[Packing, list[int]]:
        """A copy without the bins that hold any of ``taken``, and their other pieces."""
        copy, displaced = Packing(self.sizes, self.capacity), []
        rooms = []
        for name, pieces in self.bins.items():
            if taken.isdisjoint(pieces):
                copy.bins[copy.next], copy.free[copy.next] = list(pieces), self.free[name]
                rooms.append((self.free[name], copy.next))
                copy.next += 1
            else:
                displaced += [p for p in pieces if p not in taken]
        copy.order = sorted(rooms)
        return copy, displaced

    def worth(self) -> tuple[int, float]:
        """Fewer bins are better; of as many bins, the more unequal filling."""
        return -len(self.bins), sum((self.capacity - room) ** 2 for room in self.free.values())

    def assignment(self) -> np.ndarray:
        found = np.zeros(len(self.sizes), np.int64)
        for number, pieces in enumerate(self.bins.values()):
            found[pieces] = number
        return found

    @classmethod
    def of(cls, sizes: list[int], capacity: int, assignment: np.ndarray) -> Packing:
        made, members = cls(sizes, capacity), {}
        for piece, name in enumerate(assignment.tolist()):
            members.setdefault(name, []).append(piece)
        for pieces in members.values():
            made.add(pieces, capacity - sum(sizes[p] for p in pieces))
        return made


def crossed(mother: Packing, father: Packing, random: np.random.Generator) -> Packing:
    """The mother with a share of the father's well-filled bins."""
    good = sorted(father.bins, key=lambda name: (father.free[name], name))[: max(1, len(father.bins) // 2)]
    chosen = [name for name in good if random.random() < 0.5] or good[:1]
    taken = {p for name in chosen for p in father.bins[name]}
    child, displaced = mother.without(taken)
    for name in chosen:
        child.add(list(father.bins[name]), father.free[name])
    return child.fill(displaced)


def shaken(parent: Packing, random: np.random.Generator) -> Packing:
    """The parent with its emptiest bins and a few others opened and packed anew."""
    worst = sorted(parent.bins, key=lambda name: (-parent.free[name], name))[: max(2, len(parent.bins) // 50)]
    others = random.choice(list(parent.bins), min(len(parent.bins), 4), replace=False).tolist()
    taken = {p for name in {*worst, *others} for p in parent.bins[name]}
    child, _ = parent.without(taken)
    return child.fill(taken)


def evolve(sizes: np.ndarray, capacity: int, seed: int, elites: list[np.ndarray] = (), generations: int = GENERATIONS) -> np.ndarray:
    """The best packing bred from best-fit packings and given ones; it ends at the lower bound."""
    plain = sizes.tolist()
    best_fit = Packing(plain, capacity).fill(range(len(plain)))
    population = [Packing.of(plain, capacity, one) for one in elites] + [best_fit]
    bound = -(-sum(plain) // capacity)
    random = np.random.default_rng(seed)
    while len(population) < POPULATION and len(best_fit.bins) > bound:
        population.append(shaken(best_fit, random))
    for _ in range(generations):
        population.sort(key=Packing.worth, reverse=True)
        if len(population[0].bins) <= bound:
            break
        parents = population[: max(2, POPULATION // 2)]
        children = [crossed(parents[0], parents[-1], random), crossed(parents[-1], parents[0], random), shaken(parents[0], random)]
        population = [*parents, *children][:]
    return max(population, key=Packing.worth).assignment()


def _sorted(table: pa.Table) -> pa.Table:
    """Rows in an order that does not depend on how they came."""
    keys = [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending"), ("row", "ascending")]
    return table.take(pc.sort_indices(table, sort_keys=keys))


def _seed(table: pa.Table, *more: int) -> int:
    return zlib.crc32(repr((table.num_rows, table.column("shard")[0].as_py(), *more)).encode())


_ISLAND = T.StructType([*_ROWS, *fields(shard="long", island="int", number="int", bin="long")])
_PACKED = T.StructType([*_ROWS, *fields(shard="long", bin="long", room="long", offset="long")])


def _pack_round(pieces: DataFrame, shards: int, capacity: int) -> DataFrame:
    """Pack pieces within ``shards`` random shards: the islands, then the meeting of their elites."""

    def island(table: pa.Table) -> pa.Table:
        table = _sorted(table)
        found = evolve(table.column("length").to_numpy(), capacity, _seed(table, table.column("island")[0].as_py()))
        table = table.append_column("number", pa.array(np.arange(table.num_rows, dtype=np.int32)))
        return table.append_column("bin", pa.array(found)).select(_ISLAND.names)

    def meeting(table: pa.Table) -> pa.Table:
        table = table.take(pc.sort_indices(table, sort_keys=[("island", "ascending"), ("number", "ascending")]))
        count = table.num_rows // ISLANDS
        elites = [table.column("bin").slice(k * count, count).to_numpy() for k in range(ISLANDS)]
        table = table.slice(0, count)
        sizes = table.column("length").to_numpy()
        found = evolve(sizes, capacity, _seed(table), elites)
        order = np.argsort(found, kind="stable")
        held, ends = found[order], np.cumsum(sizes[order])
        first = np.flatnonzero(np.concatenate([[True], held[1:] != held[:-1]]))
        before = np.repeat(ends[first] - sizes[order][first], np.diff([*first, len(held)]))
        room = capacity - np.bincount(found, sizes).astype(np.int64)
        table = table.select([*_ROWS.names, "shard"]).take(pa.array(order))
        for name, values in (("bin", held), ("room", room[held]), ("offset", ends - sizes[order] - before)):
            table = table.append_column(name, pa.array(values.astype(np.int64)))
        return table

    shard = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "row", F.lit(shards)), F.lit(shards)).cast("long")
    dealt = pieces.select(*_ROWS.names, shard.alias("shard"), F.explode(F.array(*(F.lit(k) for k in range(ISLANDS)))).alias("island"))
    packed = dealt.groupBy("shard", "island").applyInArrow(island, _ISLAND)
    return packed.groupBy("shard").applyInArrow(meeting, _PACKED)


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to the pieces.

    Whole pieces fill a sequence each; the others are packed in rounds. ``sequence_id`` holds the
    round, the shard and the bin.
    """
    pieces, done = stored(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces"), None
    for round_number in range(ROUNDS):
        count = pieces.count()
        shards = max(1, -(-count // shard_pieces))
        packed = stored(_pack_round(pieces, shards, capacity), "packed")
        last = shards == 1 or round_number == ROUNDS - 1
        ready = packed if last else packed.where(F.col("room") * 256 <= capacity)
        number = F.lit(round_number << 56) + F.shiftleft("shard", 24) + F.col("bin")
        ready = ready.select(*PIECES.names, number.alias("sequence_id"), "offset")
        done = ready if done is None else done.unionByName(ready)
        if last:
            return done
        pieces = packed.where(F.col("room") * 256 > capacity).select(*_ROWS.names)
    return done


def pack_documents(docs: DataFrame, vocabulary: str, *, capacity: int = CAPACITY, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens, one row per piece.

    A missing text is empty: a piece with the end id alone. Longer documents are cut into whole
    pieces and a rest. Rows without an id and repeated rows are packed like others; an empty table
    gives an empty result; other columns are not read.
    """
    return pack(token_pieces(docs, vocabulary, capacity=capacity, id_column=id_column, text_column=text_column), capacity)


@query()
def op8_packing(spark, sf_dir):
    """All documents' pieces in sequences of 4096 tokens."""
    import public_tokenizers

    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
