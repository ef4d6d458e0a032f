"""Reply threads on a stream, by keyed state.

Two stateful steps follow a thread. In the first, keyed by the id of a depth-1 comment, its author meets the
depth-2 replies; in the second, keyed by the id of any known comment, its author (and its root's) meets the
depth-3 replies. Each step keeps the link of its id and the replies that name it, so a reply may come before its
parent, and a parent may be delivered again: the last copy in event time wins, as in batch. What was emitted
under another author in an earlier trigger is taken back with a count of -1 before it is emitted anew, so the sums
over all rows equal the batch result after any trigger, whatever the order of delivery. Replies and parents that
come in one trigger meet under the link that holds at its end.

Ids lie in `BUCKETS` buckets by hash, and a bucket (per salt) is one key of state: a visit of a key costs
milliseconds whatever it holds, so a state per id would cost far more than its rows. A trigger reads the links of the
buckets it touches, and their replies where a parent's author changed; work per trigger is in proportion to the rows
of these buckets, old and new. Links of one bucket are held in memory, replies are read through.

State grows with the history and lies on disk (RocksDB). Rows are appended in packs, a pack
a trigger. ``salts`` spreads the replies
of one id over that many keys; every link goes to all of them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from threadpulse.functions.scores import REPLY_CENTS
from threadpulse.operators.filters import at_depth
from threadpulse.streaming import packs

#: Buckets of ids, each with one state per salt. A checkpoint keeps the number it began with.
BUCKETS = 1024

_LINK = "link_at bigint, link_user bigint, root_user bigint"
_REPLY = "comment_id bigint, user_id bigint, at bigint"
# A link that replaces one with another root names that root in was_root.
_EVENT = f"id bigint, kind string, {_LINK}, was_root bigint, {_REPLY}, n bigint"
_FOUND = (
    "kind string, comment_id bigint, depth int, in_reply_to bigint, at bigint, author bigint, level int, n bigint"
)


class _Meeting(StatefulProcessor):
    """The links of the ids of a bucket and the replies to them. Links with equal times go by user, then root, as in
    batch."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        # Every copy of a link that counts, with how often: the step before may replace a copy. Entries are added up.
        # An entry packs many rows: (id, link_at, link_user, root_user, n) and (id, comment_id, user_id, at).
        self.links = handle.getListState("links", packs.SCHEMA)
        self.replies = handle.getListState("replies", packs.SCHEMA)
        self.kept = handle.getValueState("kept", "replies bigint")

    def close(self) -> None:
        pass

    def handleInputRows(self, key: Any, rows: Iterable[Row], timerValues: Any) -> Iterator[Row]:
        copies, entries = self.stored_links()
        earlier = self.kept.get()[0] if self.kept.exists() else 0
        before: dict[int, tuple | None] = {}  # the link of each id that got one, as it was
        changes: dict[tuple, int] = {}
        new: list[tuple] = []
        spilled = 0
        for row in rows:
            event = row.asDict()
            kind, id_ = event["kind"], event["id"]
            if kind == "link":
                own = copies.setdefault(id_, {})
                if id_ not in before:
                    before[id_] = _last(own)
                link = (event["link_at"], event["link_user"], event["root_user"])
                steps = [(link, 1)]
                if event["was_root"] is not None:
                    steps.append(((*link[:2], event["was_root"]), -1))
                for copy, n in steps:
                    own[copy] = own.get(copy, 0) + n
                    changes[id_, *copy] = changes.get((id_, *copy), 0) + n
                yield from self.passed_on(id_, event)
            elif kind == "reply":
                new.append((id_, event["comment_id"], event["user_id"], event["at"]))
                if len(new) >= packs.SIZE:
                    self.replies.appendValue(packs.pack(new))
                    spilled += len(new)
                    new = []
            else:
                yield from self.passed_on(id_, event)
        best = {id_: _last(own) for id_, own in copies.items()}
        moved = {id_: old for id_, old in before.items() if _authors(old) != _authors(best[id_])}
        if spilled or (moved and earlier):
            for at, (id_, *reply) in enumerate(packs.unpacked(self.replies)):
                if at >= earlier:
                    yield from self.matched(id_, tuple(reply), best.get(id_), 1)
                elif id_ in moved:
                    yield from self.changed(id_, tuple(reply), moved[id_], best[id_])
        for id_, *reply in new:
            yield from self.matched(id_, tuple(reply), best.get(id_), 1)
        if new:
            self.replies.appendValue(packs.pack(new))
        if new or spilled:
            self.kept.update((earlier + spilled + len(new),))
        self.store_links(copies, entries, changes)

    def stored_links(self) -> tuple[dict[int, dict[tuple, int]], int]:
        """The copies of each id, and from how many entries."""
        copies: dict[int, dict[tuple, int]] = {}
        entries = 0
        for id_, *link, n in packs.unpacked(self.links):
            own = copies.setdefault(id_, {})
            own[tuple(link)] = own.get(tuple(link), 0) + n
            entries += 1
        return copies, entries

    def store_links(self, copies: dict[int, dict[tuple, int]], entries: int, changes: dict[tuple, int]) -> None:
        """Append what changed; entries that outnumber the copies by far are written anew."""
        added = [(*link, n) for link, n in changes.items() if n]
        live = sum(n != 0 for own in copies.values() for n in own.values())
        if entries + len(added) > 2 * live + packs.SIZE:
            self.links.clear()
            added = [(id_, *link, n) for id_, own in copies.items() for link, n in own.items() if n]
        for first in range(0, len(added), packs.SIZE):
            self.links.appendValue(packs.pack(added[first : first + packs.SIZE]))

    def changed(self, key: int, reply: tuple, old: tuple | None, new: tuple | None) -> list[Row]:
        """What a reply gives under the new link and did not under the old one, and the other way round."""
        gone, come = list(self.matched(key, reply, old, -1)), []
        for row in self.matched(key, reply, new, 1):
            same = next((g for g in gone if g[:-1] == row[:-1]), None)  # n is the last column
            if same is None:
                come.append(row)
            else:
                gone.remove(same)
        return gone + come

    def passed_on(self, key: int, row: dict) -> Iterator[Row]:
        """What a link, or a row that is no reply, gives by itself."""
        raise NotImplementedError

    def matched(self, key: int, reply: tuple, link: tuple | None, n: int) -> Iterator[Row]:
        """What a reply gives under a link, n times; without a link it is an orphan."""
        raise NotImplementedError


def _last(copies: dict[tuple, int]) -> tuple | None:
    """The latest link; a root of NULL comes before any other."""
    live = (link for link, n in copies.items() if n > 0)
    return max(live, key=lambda c: (c[0], c[1], c[2] is not None, c[2]), default=None)


def _authors(link: tuple | None) -> tuple | None:
    return link and link[1:]


class _Roots(_Meeting):
    """Depth-1 comments and depth-2 replies to them -> links for the next step, and orphans of depth 2."""

    def passed_on(self, key: int, row: dict) -> Iterator[Row]:
        if row["first"]:
            yield self.event("link", key, (row["link_at"], row["link_user"], None), (None, None, None))

    def matched(self, key: int, reply: tuple, link: tuple | None, n: int) -> Iterator[Row]:
        comment, user, at = reply
        if link:
            yield self.event("link", comment, (at, user, link[1]), (comment, key, at))
        else:
            yield self.event("orphan", comment, (None, None, None), (comment, key, at), n)

    def changed(self, key: int, reply: tuple, old: tuple | None, new: tuple | None) -> list[Row]:
        if not old:
            return super().changed(key, reply, old, new)
        comment, user, at = reply
        return [self.event("link", comment, (at, user, new[1]), (comment, key, at), was_root=old[1])]

    @staticmethod
    def event(kind: str, key: int, link: tuple, reply: tuple, n: int = 1, was_root: int | None = None) -> Row:
        return Row(
            id=key,
            kind=kind,
            link_at=link[0],
            link_user=link[1],
            root_user=link[2],
            was_root=was_root,
            comment_id=reply[0],
            user_id=reply[1],
            at=reply[2],
            n=n,
        )


class _Replies(_Meeting):
    """Links of depth 1 and 2 and depth-3 replies to them -> credits, and orphans of both depths."""

    def passed_on(self, key: int, row: dict) -> Iterator[Row]:
        if row["kind"] == "orphan":
            yield self.found("orphan", row["comment_id"], 2, row["user_id"], row["at"], None, 1, row["n"])
            return
        if row["first"] and row["root_user"] is not None:
            reply = (row["comment_id"], 2, row["user_id"], row["at"])
            yield self.found("credit", *reply, row["root_user"], 1, 1)
            if row["was_root"] is not None:
                yield self.found("credit", *reply, row["was_root"], 1, -1)

    def matched(self, key: int, reply: tuple, link: tuple | None, n: int) -> Iterator[Row]:
        comment, _, at = reply
        if not link:
            yield self.found("orphan", comment, 3, key, at, None, 2, n)
            return
        for author in link[1:]:
            if author is not None:
                yield self.found("credit", comment, 3, key, at, author, 2, n)

    @staticmethod
    def found(kind: str, comment: int, depth: int, parent: int, at: int, author: int | None, level: int, n: int) -> Row:
        return Row(
            kind=kind, comment_id=comment, depth=depth, in_reply_to=parent, at=at, author=author, level=level, n=n
        )


def _salted(events: DataFrame, salts: int) -> DataFrame:
    """Replies go to one salt, links to all; ``first`` marks one copy of each row."""
    own = F.pmod(F.xxhash64("comment_id", "at"), F.lit(salts)).cast("int")
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    salt = F.explode(F.when(F.col("kind") == "link", every).otherwise(F.array(own)))
    salted = events.withColumn("salt", salt)
    return salted.withColumn("first", (F.col("salt") == 0) | (F.col("kind") != "link"))


def _met(events: DataFrame, processor: StatefulProcessor, ddl: str, salts: int) -> DataFrame:
    bucket = F.pmod(F.xxhash64("id"), F.lit(BUCKETS)).cast("int")
    keyed = _salted(events, salts).withColumn("bucket", bucket).groupBy("bucket", "salt")
    return keyed.transformWithState(processor, ddl, "append", "none")


def matches(comments: DataFrame, salts: int = 1) -> DataFrame:
    """kind, comment_id, depth, in_reply_to, ts, author, level, n for comments of valid users.

    A credit names the author whom a reply counts for, an orphan a reply whose parent is unknown. n is 1, or -1
    where an earlier row is taken back. Rows without an event time belong to no window and are left out.
    """
    timed = comments.where("ts IS NOT NULL").withColumn("at", F.unix_micros("ts"))
    none = "CAST(NULL AS BIGINT)"
    link = f"comment_id AS id, 'link' AS kind, at AS link_at, user_id AS link_user, {none} AS root_user, {none} AS was_root"
    reply = f"in_reply_to AS id, 'reply' AS kind, {none} AS link_at, {none} AS link_user, {none} AS root_user, {none} AS was_root"
    no_reply = [f"{none} AS comment_id", f"{none} AS user_id", f"{none} AS at", "1L AS n"]
    as_reply = ["comment_id", "user_id", "at", "1L AS n"]

    def events(rows: DataFrame, first: str, rest: list[str]) -> DataFrame:
        return rows.selectExpr(*first.split(", "), *rest)

    named = timed.where("in_reply_to IS NOT NULL")
    roots = events(at_depth(timed, 1).where("comment_id IS NOT NULL"), link, no_reply)
    second = events(at_depth(named, 2), reply, as_reply)
    third = events(at_depth(named, 3), reply, as_reply)
    resolved = _met(roots.unionByName(second), _Roots(), _EVENT, salts)
    found = _met(resolved.unionByName(third), _Replies(), _FOUND, salts)
    # A reply that names no parent meets nobody.
    nameless = timed.where("in_reply_to IS NULL AND depth IN (2, 3)").selectExpr(
        "'orphan' AS kind", "comment_id", "depth", "in_reply_to", "at", f"{none} AS author", "depth - 1 AS level", "1L AS n"
    )
    return found.unionByName(nameless).withColumn("ts", F.timestamp_micros("at")).drop("at")


def reply_credits(comments: DataFrame, salts: int = 1) -> DataFrame:
    """ts, author, cents, level, n: streaming counterpart of ``operators.threads.reply_credits``."""
    found = matches(comments, salts).where("kind = 'credit'")
    return found.selectExpr("ts", "author", f"{REPLY_CENTS} * n AS cents", "level", "n")


def orphan_changes(comments: DataFrame, salts: int = 1) -> DataFrame:
    """comment_id, depth, in_reply_to, ts, n: streaming counterpart of ``operators.threads.orphan_replies``.

    A reply is listed at once; when its parent comes, it is taken back.
    """
    found = matches(comments, salts).where("kind = 'orphan'")
    return found.select("comment_id", "depth", "in_reply_to", "ts", "n")


def settled(changes: DataFrame) -> DataFrame:
    """The rows of a table of changes that were not taken back, each as often as it holds (batch only)."""
    names = [c for c in changes.columns if c not in ("n", "cents")]
    sums = [F.sum(c).alias(c) for c in ("n", "cents") if c in changes.columns]
    return changes.groupBy(*names).agg(*sums).where("n > 0")
