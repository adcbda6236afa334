"""Byte-level BPE encoding and decoding by DuckDB queries inside each partition.

A text is cut by the tokenizer's pattern. Each distinct piece becomes rows (piece, position,
token), one per byte; a recursive query joins neighbouring tokens with the merge table and
contracts, per piece, the leftmost pair of smallest rank, until no pair is left. A piece that
is a token itself is that token, as the public library has it. Decoding joins ids with the
vocabulary and concatenates each text's bytes by an ordered aggregate.

Spark deals the rows; a task holds the vocabulary (fixed size), stores of at most
``CACHE_ENTRIES`` stretches, which only save work, and one block of texts. Nothing is shuffled,
so skew in the texts does not matter and a lost executor costs its running tasks only.

The recursive query returns the rows of all its rounds, so a block is bounded in bytes, and a
piece of over ``LONG_BYTES`` is done alone by queries of a bounded number of rounds, each going
on from the last round of the one before. There a round contracts every pair of smallest rank
at once, from the left, unless the token made is part of one of smaller rank: a piece takes a
round per different token made, so a word of many thousand letters is slow, yet right.

Null texts have no tokens and decode to empty bytes; an id outside the vocabulary, or null,
raises. Every other column of the input is left alone. Repeated rows give repeated rows.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import repeat

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from feedlake.llm.common import give_back, keeps, narrow

#: Stretches of text, and of ids, that a Python worker remembers before it forgets the rarer ones.
CACHE_ENTRIES = 400_000
#: Distinct pieces that one DuckDB query handles.
BLOCK_PIECES = 4_000
#: Bytes of the pieces that one DuckDB query handles, and of a piece that is done by itself.
PIECES_BYTES = 1 << 20
LONG_BYTES = 128
#: Rows that the rounds of one query on a long piece may return, where one round has fewer.
ROUND_ROWS = 4_000_000
#: Bytes of text, and ids, that are handled at once.
BLOCK_BYTES = 2 << 20
BLOCK_IDS = 250_000

#: A round per contraction: the rows of every piece that still has a pair to contract. Each row
#: knows the token and the place that follow it, so that a round sorts nothing.
_ENCODE = """
with recursive contracted(round, piece, pos, token, follow, next_pos) as (
    select 0, piece, pos, token, follow, next_pos from bytes_of_pieces
    union all
    select * from (
        with least as (
            select piece, min((merged::bigint << 32) | pos) as chosen, min_by(next_pos, (merged::bigint << 32) | pos) as gone
            from contracted join merges on token = left_token and follow = right_token group by piece),
        joined as (
            select l.piece, (chosen & 4294967295)::integer as place, (chosen >> 32)::integer as merged, gone,
                   c.follow as beyond, c.next_pos as beyond_pos
            from contracted as c join least as l on c.piece = l.piece and c.pos = l.gone)
        select round + 1, c.piece, pos,
               case when pos = place then merged else token end,
               case when pos = place then beyond when next_pos = place then merged else follow end,
               case when pos = place then beyond_pos else next_pos end
        from contracted as c join joined as j on c.piece = j.piece where pos <> gone))
select round, piece, pos, token from contracted
"""

#: The same on one long piece: all pairs of smallest rank, every second where they overlap.
_ENCODE_LONG = """
with recursive contracted(round, pos, token) as (
    select 0, pos, token from bytes_of_piece
    union all
    select * from (
        with pairs as (
            select round, pos, token, lead(token) over following as next_token, row_number() over following as place
            from contracted window following as (order by pos)),
        ranked as (
            select place, merged, lone, min(merged) over () as least, min(place) over (partition by merged) as leftmost
            from pairs join merges on token = left_token and next_token = right_token),
        wanted as (
            select place, merged, place - row_number() over (order by place) as stretch
            from ranked where merged = least and (not lone or place = leftmost)),
        chosen as (
            select place, merged from (
                select place, merged, row_number() over (partition by stretch order by place) as nth from wanted)
            where nth % 2 = 1)
        select round + 1, pos, coalesce(c.merged, token)
        from pairs left join chosen as c on pairs.place = c.place left join chosen as g on pairs.place = g.place + 1
        where g.place is null and round < $rounds and exists (select 1 from chosen)))
select round, pos, token from contracted where round = (select max(round) from contracted) order by pos
"""

_DECODE = """
select run, string_agg(hex, '' order by pos) as hex
from ids_of_runs join vocabulary on id = token group by run
"""

class Store:
    """Sequences of numbers by key, in one growing array."""

    def __init__(self, kind: type = np.int32):
        self.code: dict = {}
        self.at, self.held, self.uses = np.zeros(1, np.int64), np.zeros(0, kind), np.zeros(0, np.int32)

    def put(self, keys: list, flat: np.ndarray, lengths: np.ndarray) -> None:
        first = len(self.code)
        self.code.update(zip(keys, range(first, first + len(keys)), strict=True))
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(lengths)])
        self.held = np.concatenate([self.held, flat])
        self.uses = np.concatenate([self.uses, np.zeros(len(keys), np.int32)])

    def codes(self, keys: list, learn: Callable[[list], None]) -> np.ndarray:
        """Where the sequences of ``keys`` are; ``learn`` puts those that are not held. If there
        would be too many, only those used most often stay, a third of what fits."""
        found = np.fromiter(map(self.code.get, keys, repeat(-1)), np.int64, len(keys))
        missing = {keys[i] for i in np.flatnonzero(found < 0).tolist()}
        if len(self.code) + len(missing) > CACHE_ENTRIES:
            self._prune(CACHE_ENTRIES // 3)
            found = np.fromiter(map(self.code.get, keys, repeat(-1)), np.int64, len(keys))
            missing = {keys[i] for i in np.flatnonzero(found < 0).tolist()}
        if missing:
            learn(list(missing))
            new = np.flatnonzero(found < 0)
            found[new] = [self.code[keys[i]] for i in new.tolist()]
        self.uses[found] += 1
        return found

    def get(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sequences of ``codes`` one after another, and the length of each."""
        first = self.at[codes]
        lengths = self.at[codes + 1] - first
        ends = np.cumsum(lengths)
        return self.held[np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + lengths, lengths)], lengths

    def _prune(self, most: int) -> None:
        stay = np.sort(np.argsort(-self.uses, kind="stable")[:most])
        names, uses = list(self.code), self.uses[stay] // 2
        held, lengths = self.get(stay)
        self.__init__(self.held.dtype.type)
        self.put([names[i] for i in stay.tolist()], held, lengths)
        self.uses = uses


class Codec:
    """One worker's vocabulary, DuckDB connection and memory of stretches."""

    def __init__(self, ranks_path: str, pattern: str):
        with open(ranks_path, "rb") as lines:
            rows = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in rows}
        self.cut = regex.compile(pattern)
        self.pieces, self.stretches, self.runs = Store(), Store(), Store(np.uint8)
        top = max(self.ranks.values()) + 1
        self.known, self.spaced, self.single = np.zeros(top, bool), np.zeros(top, bool), np.full(256, -1, np.int32)
        left, right, merged = [], [], []
        for token, rank in self.ranks.items():
            self.known[rank], self.spaced[rank] = True, token[:1] == b" "
            if len(token) == 1:
                self.single[token[0]] = rank
            for i in range(1, len(token)):
                a, b = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), merged.append(rank)
        self.db = duckdb.connect()
        self.db.execute("set threads = 1")
        # A token that is part of one of smaller rank: once made, that pair comes before its like.
        early = {part for a, b, m in zip(left, right, merged, strict=True) for part in (a, b) if part > m}
        lone = pa.array([m in early for m in merged], pa.bool_())
        merges = pa.table({"left_token": pa.array(left, pa.int32()), "right_token": pa.array(right, pa.int32()), "merged": pa.array(merged, pa.int32()), "lone": lone})
        vocabulary = pa.table({"token": pa.array(list(self.ranks.values()), pa.int32()), "hex": [t.hex() for t in self.ranks]})
        for name, rows in (("merges", merges), ("vocabulary", vocabulary)):
            self.db.register("given", rows)
            self.db.execute(f"create table {name} as select * from given")
            self.db.unregister("given")

    def _contract_long(self, coded: bytes) -> np.ndarray:
        """The ids of one piece; no query returns more than about ``ROUND_ROWS`` rows."""
        token = self.single[np.frombuffer(coded, np.uint8)]
        while True:
            rounds = max(1, ROUND_ROWS // len(token))
            self.db.register("bytes_of_piece", pa.table({"pos": np.arange(len(token), dtype=np.int32), "token": token}))
            got = self.db.execute(_ENCODE_LONG, {"rounds": rounds}).fetchnumpy()
            self.db.unregister("bytes_of_piece")
            token = np.asarray(got["token"], np.int32)
            if got["round"][0] < rounds:
                return token

    def _contract(self, pieces: list[str]) -> None:
        """Puts the ids of ``pieces``, none of them a token, into the store."""
        sizes = [len(piece.encode()) for piece in pieces]
        for piece in [piece for piece, size in zip(pieces, sizes, strict=True) if size > LONG_BYTES]:
            ids = self._contract_long(piece.encode())
            self.pieces.put([piece], ids, np.array([len(ids)]))
        short = [(piece, size) for piece, size in zip(pieces, sizes, strict=True) if size <= LONG_BYTES]
        for first, last in _blocks(np.array([size for _, size in short], np.int64), PIECES_BYTES):
            self._contract_short([piece for piece, _ in short[first:last]])

    def _contract_short(self, pieces: list[str]) -> None:
        for i in range(0, len(pieces), BLOCK_PIECES):
            block = pieces[i : i + BLOCK_PIECES]
            coded = [piece.encode() for piece in block]
            n = np.fromiter(map(len, coded), np.int64, len(coded))
            at = np.concatenate([[0], np.cumsum(n)])
            token = self.single[np.frombuffer(b"".join(coded), np.uint8)]
            follow = np.append(token[1:], np.int32(-1))
            follow[at[1:] - 1] = -1  # no merge has it
            pos = (np.arange(at[-1]) - np.repeat(at[:-1], n)).astype(np.int32)
            piece = np.repeat(np.arange(len(n), dtype=np.int32), n)
            rows = pa.table({"piece": piece, "pos": pos, "token": token, "follow": follow, "next_pos": pos + np.int32(1)})
            self.db.register("bytes_of_pieces", rows)
            got = {k: np.asarray(v) for k, v in self.db.execute(_ENCODE).fetchnumpy().items()}
            self.db.unregister("bytes_of_pieces")
            later, last = np.argsort(got["round"], kind="stable"), np.zeros(len(block), np.int64)
            last[got["piece"][later]] = got["round"][later]
            final = np.flatnonzero(got["round"] == last[got["piece"]])
            final = final[np.lexsort((got["pos"][final], got["piece"][final]))]
            sizes = np.bincount(got["piece"][final], minlength=len(block))
            self.pieces.put(block, got["token"][final].astype(np.int32), sizes)

    def _learn_pieces(self, pieces: list[str]) -> None:
        ranks = [self.ranks.get(piece.encode(), -1) for piece in pieces]
        whole = [(piece, rank) for piece, rank in zip(pieces, ranks, strict=True) if rank >= 0]
        self.pieces.put([piece for piece, _ in whole], np.array([rank for _, rank in whole], np.int32), np.ones(len(whole), np.int64))
        self._contract([piece for piece, rank in zip(pieces, ranks, strict=True) if rank < 0])

    def _learn(self, keys: list[str]) -> None:
        """Puts the ids of the stretches of ``keys`` into the store."""
        cut = [[" " + key] if key.isalpha() else self.cut.findall(key[1:] if key[:1] == " " else " " + key) for key in keys]
        ids, sizes = self.pieces.get(self.pieces.codes([piece for one in cut for piece in one], self._learn_pieces))
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum([0, *map(len, cut)])]
        self.stretches.put(keys, ids, np.diff(ends))

    def _learn_runs(self, runs: list[int]) -> None:
        """Puts the bytes of runs of one token or two: the first, and one more than the second or 0."""
        for i in range(0, len(runs), BLOCK_PIECES):
            block = np.array(runs[i : i + BLOCK_PIECES], np.int64)
            pairs = np.stack([block >> 32, (block & 0xFFFFFFFF) - 1], axis=1).astype(np.int32)
            run, pos = np.nonzero(pairs >= 0)
            rows = pa.table({"run": run.astype(np.int32), "pos": pos.astype(np.int32), "id": pairs[run, pos]})
            self.db.register("ids_of_runs", rows)
            got = self.db.execute(_DECODE).fetchnumpy()
            self.db.unregister("ids_of_runs")
            made = [bytes.fromhex(x) for x in got["hex"]]
            self.runs.put(block[got["run"]].tolist(), np.frombuffer(b"".join(made), np.uint8), np.fromiter(map(len, made), np.int64, len(made)))

    def encode(self, texts: list[str | None] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and the number of ids of each.

        A space between two characters that are no white space begins a piece whatever stands
        around it, so texts are cut there first and each distinct stretch is done once. Its key
        is what follows the space; or, for a stretch without one, a space and the stretch. A
        text with other white space beside a space is cut into its pieces.
        """
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        if not len(texts):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        split = pc.split_pattern(pc.fill_null(texts, ""), " ")
        coded = split.flatten().dictionary_encode()
        which = coded.indices.to_numpy()
        many = pc.list_value_length(split).to_numpy().astype(np.int64)
        first = np.cumsum(many) - many
        words, uneven = coded.dictionary.to_pylist(), _unsure(coded.dictionary)
        for k in np.flatnonzero(uneven).tolist():
            uneven[k] = not words[k] or words[k][0].isspace() or words[k][-1].isspace()
        odd = np.logical_or.reduceat(uneven[which], first)
        cut = {i: [" " + piece for piece in self.cut.findall(texts[i].as_py() or "")] for i in np.flatnonzero(odd).tolist()}
        within = ~np.repeat(odd, many)
        within[first] = False
        used = np.unique(which[within])
        leading = [" " + words[k] for k in which[first[~odd]].tolist()]
        keys = [words[k] for k in used.tolist()] + leading + [piece for one in cut.values() for piece in one]
        codes = self.stretches.codes(keys, self._learn)
        many[list(cut)] = [len(one) for one in cut.values()]
        last = np.cumsum(many)
        flat, rest = np.empty(last[-1], np.int64), ~np.repeat(odd, many)
        flat[(last - many)[~odd]] = codes[len(used) : len(used) + len(leading)]
        flat[~rest] = codes[len(used) + len(leading) :]
        rest[(last - many)[~odd]] = False
        of = np.zeros(len(words), np.int64)
        of[used] = codes[: len(used)]
        flat[rest] = of[which[within]]
        ids, lengths = self.stretches.get(flat)
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], last])]
        return ids, np.diff(ends)

    def decode(self, ids: np.ndarray, lengths: np.ndarray) -> list[bytes]:
        """The bytes of texts of ``lengths`` ids each. Ids are cut where a token begins with a
        space, and after every second token from there; each distinct run is decoded once."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.known) or not self.known[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        at = np.concatenate([[0], np.cumsum(lengths)])
        begins = self.spaced[ids]
        begins[at[:-1][lengths > 0]] = True
        place = np.arange(len(ids))
        begins |= (place - np.maximum.accumulate(np.where(begins, place, 0))) % 2 == 0
        cuts = np.flatnonzero(begins)
        sizes = np.diff(cuts, append=len(ids))
        after = ids[np.minimum(cuts + 1, max(len(ids) - 1, 0))].astype(np.int64)
        coded = pa.array((ids[cuts].astype(np.int64) << 32) | np.where(sizes == 2, after + 1, 0)).dictionary_encode()
        runs = coded.dictionary.to_pylist()
        out, n = self.runs.get(self.runs.codes(runs, self._learn_runs)[coded.indices.to_numpy()])
        ends = np.concatenate([[0], np.cumsum(n)])[np.searchsorted(cuts, at)].tolist()
        held = out.tobytes()
        return [held[a:b] for a, b in zip(ends, ends[1:], strict=False)]


@lru_cache(maxsize=1)
def codec(ranks_path: str, pattern: str) -> Codec:
    """Kept by the Python worker, which Spark uses for many tasks."""
    return Codec(ranks_path, pattern)


keeps(codec.cache_clear)


def _unsure(words: pa.Array) -> np.ndarray:
    """Which words are empty or may begin or end with white space, by their first and last bytes."""
    at, data = (np.frombuffer(b, kind) for b, kind in zip(words.buffers()[1:], (np.int64 if pa.types.is_large_string(words.type) else np.int32, np.uint8), strict=True))
    at = at[words.offset : words.offset + len(words) + 1]
    visible = np.zeros(256, bool)
    visible[0x21:0x7F] = True
    data = data if len(data) else np.zeros(1, np.uint8)
    empty, top = at[1:] == at[:-1], len(data) - 1
    return empty | ~visible[data[np.minimum(at[:-1], top)]] | ~visible[data[np.maximum(at[1:] - 1, 0)]]


def _blocks(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    at, first = np.concatenate([[0], np.cumsum(sizes)]), 0
    while first < len(sizes):
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
        yield first, min(last, len(sizes))
        first = last


def encode(
    df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False
) -> DataFrame:
    """(``id_col``, ids array<int>) per row; ``ranks_path`` must exist on every executor.

    With ``decoded`` also the bytes that the ids decode to, made in the same pass, so that a task
    keeps one worker and one vocabulary.
    """
    rows = narrow(df, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks_path, pattern)
        for batch in batches:
            texts = batch.column(1)
            sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0))
            for first, last in _blocks(sizes, BLOCK_BYTES):
                flat, lengths = c.encode(texts.slice(first, last - first))
                at = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                columns = [batch.column(0).slice(first, last - first), pa.ListArray.from_arrays(at, flat)]
                if decoded:
                    made = [x for a, b in _blocks(lengths, BLOCK_IDS) for x in c.decode(flat[at[a] : at[b]], lengths[a:b])]
                    columns.append(pa.array(made, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, [id_col, "ids", "decoded"][: len(columns)])
            give_back()

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, ids array<int>" + ", decoded binary" * decoded)


def decode(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(``id_col``, ids, decoded binary) per row; null ids decode to empty bytes."""
    rows = narrow(df, id_col, ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks_path, pattern)
        for batch in batches:
            lists = batch.column(1)
            sizes = np.asarray(pc.fill_null(pc.list_value_length(lists), 0))
            for first, last in _blocks(sizes, BLOCK_IDS):
                flat = lists.slice(first, last - first).flatten()
                if flat.null_count:
                    raise ValueError("an id is null")
                out = c.decode(np.asarray(flat, np.int32), sizes[first:last])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), lists.slice(first, last - first), pa.array(out, pa.binary())], [id_col, "ids", "decoded"]
                )

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, decoded binary")


def token_digests(df: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Per document its token count and the digests of its ids and of the bytes they decode to."""
    return encode(df, ranks_path, pattern, decoded=True).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
