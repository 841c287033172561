"""Byte-level BPE in DuckDB, run by every Spark task on the pieces of its own partition.

Encoding is a recursive query: rows of (word, place, token) join the merge table
with their right neighbours, and each word's leftmost pair of the least rank is
contracted until no pair is left. Decoding is an aggregation ordered by place.
Each distinct piece of text is encoded once while it is remembered.
"""

import base64
import functools
import hashlib
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cauce.llm import pieces as P

#: Pieces of more bytes contract all pairs of the least rank in one round where that is the same.
LONG = 200
#: Rounds of one query over long pieces; the next one goes on from there.
ROUNDS = 64

# A pair is a token and the one that starts where it stops.
_PAIRS = """
    SELECT l.word, l.pos, r.pos AS second, r.stop, rank, safe
    FROM t l JOIN t r ON l.word = r.word AND l.stop = r.pos JOIN merges ON a = l.tok AND b = r.tok
"""
_CONTRACT = """
    SELECT round + 1, t.word, t.pos, coalesce(m.stop, t.stop), coalesce(m.rank, t.tok)
"""
ENCODE = f"""
    WITH RECURSIVE t(round, word, pos, stop, tok) AS (
        SELECT 0, word, pos, stop, tok FROM tokens
        UNION ALL
        (WITH p AS ({_PAIRS}), m AS (
            SELECT word, arg_min(struct_pack(pos, second, stop, rank), rank::BIGINT << 32 | pos) AS x
            FROM p GROUP BY word
        )
        SELECT round + 1, t.word, t.pos, CASE WHEN t.pos = x.pos THEN x.stop ELSE t.stop END,
            CASE WHEN t.pos = x.pos THEN x.rank ELSE t.tok END
        FROM t JOIN m ON t.word = m.word WHERE t.pos <> x.second)
    )
    SELECT word, pos, stop, tok FROM t QUALIFY round = max(round) OVER (PARTITION BY word) ORDER BY word, pos
"""
# Merging all pairs of rank r from left to right equals merging them one by one
# where no pair with token r has a lesser rank (``safe``). Of overlapping pairs
# every second one stays.
ENCODE_LONG = f"""
    WITH RECURSIVE t(round, word, pos, stop, tok) AS (
        SELECT 0, word, pos, stop, tok FROM tokens
        UNION ALL
        (WITH p AS ({_PAIRS}), least AS (
            SELECT *, lag(second) OVER (PARTITION BY word ORDER BY pos) AS before,
                row_number() OVER (PARTITION BY word ORDER BY pos) AS nth
            FROM (SELECT *, min(rank) OVER (PARTITION BY word) AS lowest FROM p) WHERE rank = lowest
        ), runs AS (
            SELECT *, sum((before IS DISTINCT FROM pos)::INT) OVER (PARTITION BY word ORDER BY pos) AS run
            FROM least WHERE safe OR nth = 1
        ), m AS (
            SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY word, run ORDER BY pos) % 2 = 1
        )
        {_CONTRACT}
        FROM t JOIN (SELECT DISTINCT word FROM p) USING (word)
        LEFT JOIN m ON m.word = t.word AND m.pos = t.pos
        LEFT JOIN m AS gone ON gone.word = t.word AND gone.second = t.pos
        WHERE gone.pos IS NULL AND round < {ROUNDS})
    )
    SELECT word, pos, stop, tok, round FROM t QUALIFY round = max(round) OVER (PARTITION BY word) ORDER BY word, pos
"""
DECODE = """
    SELECT row, string_agg(letters, '' ORDER BY pos) AS letters
    FROM tokens JOIN vocabulary ON id = tok GROUP BY row ORDER BY row
"""


class Codec:
    """Ranks of a vocabulary in a database that only this process has."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pattern = regex.compile(pattern)
        self.bytes = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "600MB", "temp_directory": f"{tempfile.gettempdir()}/bpe"})
        rules = [
            (self.ranks[token[:i]], self.ranks[token[i:]], rank)
            for token, rank in self.ranks.items()
            for i in range(1, len(token))
            if token[:i] in self.ranks and token[i:] in self.ranks
        ]
        a, b, rank = np.array(rules, np.int32).reshape(-1, 3).T
        lowest = np.full(max(self.ranks.values()) + 1, np.iinfo(np.int32).max)
        np.minimum.at(lowest, a, rank)
        np.minimum.at(lowest, b, rank)
        merges = {"a": a, "b": b, "rank": rank, "safe": lowest[rank] > rank}
        # One character per byte, so that any bytes are a text.
        letters = [token.decode("latin-1") for token in self.ranks]
        vocabulary = {"id": pa.array(list(self.ranks.values()), pa.int32()), "letters": letters}
        for name, columns in (("merges", merges), ("vocabulary", vocabulary)):
            self.db.register("given", pa.table(columns))
            self.db.sql(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.db.unregister("given")
        self.digits = [str(i) for i in range(max(self.ranks.values()) + 1)]
        self.memo = P.Memo(self._encode_chunks, 1_400_000)

    def _run(self, query: str, tokens: pa.Table) -> pa.Table:
        self.db.register("tokens", tokens)
        found = self.db.sql(query).to_arrow_table()
        self.db.unregister("tokens")
        return found

    def _merge(self, words: list[bytes], query: str) -> list[bytes]:
        """Token ids of each word, as bytes."""
        sizes = np.array([len(w) for w in words])
        data = np.frombuffer(b"".join(words), np.uint8)
        word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        pos = (np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)
        state = pa.table({"word": word, "pos": pos, "stop": pos + np.int32(1), "tok": self.bytes[data]})
        state = self._run(query, state)
        if "round" in state.column_names:
            # Words that used up their rounds go on; the others are done.
            while (last := state["round"].to_numpy() == ROUNDS).any():
                more = self._run(query, state.filter(pa.array(last)).drop_columns("round"))
                state = pa.concat_tables([state.filter(pa.array(~last)), more]).sort_by([("word", "ascending"), ("pos", "ascending")])
        ids = state["tok"].to_numpy().astype("<i4")
        ends = np.searchsorted(state["word"].to_numpy(), np.arange(len(words) + 1))
        return [ids[a:b].tobytes() for a, b in zip(ends, ends[1:])]

    def encode_words(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of matches of the pattern; one that is a token itself is not taken apart."""
        found = {w: np.array([self.ranks[w]], "<i4").tobytes() for w in words if w in self.ranks}
        rest = [w for w in dict.fromkeys(words) if w not in found]
        for group, query in (
            ([w for w in rest if len(w) <= LONG], ENCODE),
            ([w for w in rest if len(w) > LONG], ENCODE_LONG),
        ):
            start = 0
            while start < len(group):
                stop, size = start, 0
                while stop < len(group) and size < 1 << 19:
                    size += len(group[stop])
                    stop += 1
                found.update(zip(group[start:stop], self._merge(group[start:stop], query)))
                start = stop
        return found

    def _encode_chunks(self, chunks: list[bytes]) -> list[bytes]:
        split = [[m.encode() for m in self.pattern.findall(c.decode())] for c in chunks]
        ids = self.encode_words([w for words in split for w in words])
        return [b"".join(map(ids.__getitem__, words)) for words in split]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows and the row offsets; NULL counts as empty."""
        offsets, data = P.text_bytes(column)
        bounds, first = P.chunks(offsets, data)
        codes, known = P.distinct(bounds, data)
        values, starts = P.ragged(self.memo(known), "<i4")
        ids, ends = P.gather(values, starts, codes)
        return ids, ends[first]

    def decode(self, ids: np.ndarray, rows: np.ndarray) -> list[bytes]:
        """The bytes of each row's ids."""
        sizes = np.diff(rows)
        row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        pos = np.arange(len(ids), dtype=np.int64)
        found = self._run(DECODE, pa.table({"row": row, "pos": pos, "tok": ids.astype(np.int32)}))
        out = [b""] * len(sizes)
        for i, letters in zip(found["row"].to_pylist(), found["letters"].to_pylist()):
            out[i] = letters.encode("latin-1")
        return out


@functools.cache
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode_decode(docs: DataFrame, path: str, pattern: str, digests_only: bool = False) -> DataFrame:
    """Per row of (doc_id, text): doc_id, ids, n_tokens, ids_sha256, decoded and decoded_sha256.

    ids_sha256 is of the decimal ids joined by commas; both digests are lowercase
    hex. A NULL text is empty and has no ids. Whole texts of any length are
    encoded; repeated rows give the same again. Other columns are not read.
    ``digests_only`` leaves out ids and decoded.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, ids array<int>, n_tokens long, ids_sha256 string, decoded binary, decoded_sha256 string"
    )
    names = ["doc_id", "ids", "n_tokens", "ids_sha256", "decoded", "decoded_sha256"]
    if digests_only:
        schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
        names = [n for n in names if n not in ("ids", "decoded")]

    def run(batches):
        own = codec(path, pattern)
        for block in P.blocks(batches, "text"):
            ids, rows = own.encode(block["text"])
            decoded = own.decode(ids, rows)
            digits = list(map(own.digits.__getitem__, ids.tolist()))
            listed = [",".join(digits[a:b]) for a, b in zip(rows.tolist(), rows[1:].tolist())]
            columns = {
                "doc_id": block["doc_id"],
                "ids": pa.ListArray.from_arrays(pa.array(rows, pa.int32()), pa.array(ids, pa.int32())),
                "n_tokens": pa.array(np.diff(rows)),
                "ids_sha256": pa.array([hashlib.sha256(x.encode()).hexdigest() for x in listed]),
                "decoded": pa.array(decoded, pa.binary()),
                "decoded_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in decoded]),
            }
            yield pa.record_batch([columns[n] for n in names], names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
