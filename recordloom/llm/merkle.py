"""Merkle manifest of a table: leaves, roots and inclusion proofs, with every proof folded back.

Each row is a leaf. The leaves of one group (`lang`) ascend by id and form a tree with runs of
`FAN` nodes; the groups' roots, in order of the group, form one more tree above them.

Subtrees are exchanged by superblock: `FAN ** DEPTH` consecutive nodes of a tree. On the way up,
every superblock is reduced to one node, and these are the nodes of the next round, until
each tree is one node. On the way down, the nodes of each superblock are cogrouped with what lies
outside of it on the way to the root (`outer`: per level the place in its run, and the siblings).
The cogroup repeats its local reduction, joins local and outer siblings to proofs, and folds.
So no task holds more than one superblock, however large a group is, and only digests move.

Digests are lower-case hex SHA-256. A field is `-` if null, else its UTF-8 length in bytes,
`:` and the value; a node is the digest of its children's hex digests, one after the other.

Defined results: a null group is a group, and comes first. Rows of one id, and rows without id
(these first), are ordered by their leaves, so equal rows lie side by side. An empty text is
`0:`. An empty table gives an empty manifest. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.llm.ship import ship, stored
from recordloom.operators import ranges

FAN = 8
DEPTH = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A tree: whether its group has a name, the name, and the number of nodes. Then a superblock.
_TREE = ["named", "name", "n"]
_BLOCK = [*_TREE, "block"]
_TREE_TYPE = "named boolean, name string, n long"
# Place in the run and siblings (hex digests joined), from the lowest outer level to the root.
_OUTER = "array<struct<at:int,beside:string>>"

Path = list[tuple[int, str]]


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(field, fields)).cast("binary"), 256)


def lower_cased(text: Column) -> Column:
    """The text as tampering leaves it: A-Z as a-z, nothing else changed."""
    return F.translate(text.cast("string"), _UPPER, _LOWER)


def _hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _levels(n: int) -> int:
    """Levels above the nodes of a tree of `n` of them."""
    levels = 0
    while n > 1:
        n = -(-n // FAN)
        levels += 1
    return levels


def _reduced(digests: list[str], n: int, depth: int) -> list[list[str]]:
    """The levels of a superblock from its nodes up, as far as it or its tree of `n` nodes goes."""
    rows = [digests]
    for _ in range(min(depth, _levels(n))):
        last = rows[-1]
        rows.append([_hex("".join(last[i : i + FAN])) for i in range(0, len(last), FAN)])
    return rows


def _paths(rows: list[list[str]]) -> list[Path]:
    """Place and siblings of every node at each level within its superblock."""
    above: list[Path] = [[] for _ in rows[-1]]
    for row in reversed(rows[:-1]):
        below = []
        for at in range(len(row)):
            place = at % FAN
            run = row[at - place : at - place + FAN]
            below.append([(place, "".join(run[:place] + run[place + 1 :])), *above[at // FAN]])
        above = below
    return above


def _folded(digest: str, path: Path) -> str:
    """The root that follows from a node and its siblings."""
    for place, beside in path:
        cut = len(digest) * place
        digest = _hex(beside[:cut] + digest + beside[cut:])
    return digest


def _raised(nodes: DataFrame, depth: int) -> DataFrame:
    """One node for each superblock; its tree has as many nodes as superblocks before (`under`: `n` before)."""

    def top(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        named, name, n, block = key
        digest = _reduced(rows.sort_values("pos")["digest"].tolist(), int(n), depth)[-1]
        fewer = -(-int(n) // FAN**depth)
        return pd.DataFrame(
            {"named": named, "name": name, "n": fewer, "pos": block, "digest": digest, "under": n}
        )

    schema = f"{_TREE_TYPE}, pos long, digest string, under long"
    return nodes.groupBy(*_BLOCK).applyInPandas(top, schema)


def _lowered(nodes: DataFrame, outer: DataFrame, depth: int) -> DataFrame:
    """The superblocks cogrouped with their outer nodes: the path of every node (`pos`, `under`) to the root."""

    def descend(key: tuple, rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        beyond = [{"at": x["at"], "beside": x["beside"]} for x in above["outer"].iloc[0]]
        paths = _paths(_reduced(rows["digest"].tolist(), int(key[2]), depth))
        outer = [[*({"at": a, "beside": b} for a, b in path), *beyond] for path in paths]
        return pd.DataFrame(
            {"named": key[0], "name": key[1], "n": rows["under"].tolist(), "block": rows["pos"].tolist(),
             "outer": outer, "subroot": above["subroot"].iloc[0]}
        )

    schema = f"{_TREE_TYPE}, block long, outer {_OUTER}, subroot string"
    return nodes.groupBy(*_BLOCK).cogroup(outer.groupBy(*_BLOCK)).applyInPandas(descend, schema)


def _with_blocks(nodes: DataFrame, depth: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"pos div {FAN**depth}"))


def _rounds(nodes: DataFrame, depth: int, tag: str) -> list[DataFrame]:
    """The nodes, those of the next round, and so on to one node for each tree."""
    longest = nodes.agg(F.max("n")).first()[0] or 0
    rounds = [_with_blocks(nodes, depth)]
    while len(rounds) == 1 or longest > 1:
        rounds.append(_with_blocks(stored(_raised(rounds[-1], depth), f"{tag}-nodes"), depth))
        longest = -(-longest // FAN**depth)
    return rounds


def _outer(rounds: list[DataFrame], roots: DataFrame, depth: int, tag: str) -> DataFrame:
    """Per superblock of the first round what lies outside; `roots`: `named, name, outer, subroot`."""
    found = rounds[-1].select("named", "name", F.col("under").alias("n"), "block").join(roots, ["named", "name"])
    for nodes in reversed(rounds[1:-1]):
        found = stored(_lowered(nodes, found, depth), f"{tag}-outer")
    return found


def _placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows (`named, name` and more) with their place `pos` (from 0) in their tree and its size `n`."""
    return ranges.numbered(rows, order, ["named", "name"], "pos", "n").withColumn("pos", F.col("pos") - 1)


def _checked(leaves: DataFrame, outer: DataFrame, depth: int) -> DataFrame:
    """The superblocks of leaves cogrouped with their outer nodes: proofs joined, leaves folded to the root."""

    def check(key: tuple, rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        beyond = [(x["at"], x["beside"]) for x in above["outer"].iloc[0]]
        digests = rows["digest"].tolist()
        paths = [path + beyond for path in _paths(_reduced(digests, int(key[2]), depth))]
        starts = [t if isinstance(t, str) else d for t, d in zip(rows["tampered"], digests, strict=True)]
        return pd.DataFrame(
            {"doc_id": rows["doc_id"].tolist(), "leaf": digests, "subroot": above["subroot"].iloc[0],
             "proof_sha256": [_hex("".join(b for _, b in path)) for path in paths],
             "folded_root": [_folded(d, path) for d, path in zip(starts, paths, strict=True)]}
        )

    # The id travels as text: pandas would turn long ids into doubles where nulls are among them.
    schema = "doc_id string, leaf string, subroot string, proof_sha256 string, folded_root string"
    rows = leaves.withColumn("doc_id", F.col("doc_id").cast("string"))
    return rows.groupBy(*_BLOCK).cogroup(outer.groupBy(*_BLOCK)).applyInPandas(check, schema)


def manifest(docs: DataFrame, tampered: Column | None = None, depth: int = DEPTH) -> DataFrame:
    """`doc_id, leaf, subroot, root, proof_sha256, folded_root, verified` for every row.

    Where `tampered` holds, the leaf that is folded is that of the lower-cased text; the other
    columns come from the rows as they are. A superblock has `FAN ** depth` nodes.
    """
    ship(docs.sparkSession)
    fields = [F.col(c) for c in FIELDS]
    lang = F.col("lang").cast("string")
    wrong = F.lit(False) if tampered is None else tampered
    leaves = stored(
        docs.select(
            lang.isNotNull().alias("named"),
            F.coalesce(lang, F.lit("")).alias("name"),
            F.col("doc_id").cast("long").alias("doc_id"),
            leaf(fields).alias("digest"),
            F.when(wrong, leaf([*fields[:-1], lower_cased(fields[-1])])).alias("tampered"),
        ),
        "merkle-leaves",
    )
    rows = stored(_placed(leaves, ["doc_id", "digest"]), "merkle-placed")
    rounds = _rounds(rows.select(*_TREE, "pos", "digest"), depth, "merkle")
    # The upper tree has the groups' roots as its nodes, in order of the group.
    members = rounds[-1].select(
        F.lit(True).alias("named"), F.lit("").alias("name"), F.struct("named", "name").alias("member"), "digest"
    )
    upper = stored(_placed(members, ["member"]), "merkle-upper").withColumn("under", F.col("pos"))
    upper_rounds = _rounds(upper.select(*_TREE, "pos", "digest", "under"), depth, "merkle-upper")
    top = upper_rounds[-1].select(
        "named", "name", F.array().cast(_OUTER).alias("outer"), F.col("digest").alias("subroot")
    )
    paths = _lowered(upper_rounds[0], _outer(upper_rounds, top, depth, "merkle-upper"), depth)
    paths = paths.select(F.col("block").alias("pos"), "outer", F.col("subroot").alias("root"))
    groups = stored(
        upper.join(paths, "pos").select("member.named", "member.name", "outer", F.col("digest").alias("subroot"), "root"),
        "merkle-groups",
    )
    root = groups.select("root").first()
    outer = _outer(rounds, groups.drop("root"), depth, "merkle")
    found = _checked(_with_blocks(rows, depth), outer, depth)
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "leaf",
        "subroot",
        F.lit(root["root"] if root else None).cast("string").alias("root"),
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == F.lit(root["root"] if root else None)).alias("verified"),
    )
