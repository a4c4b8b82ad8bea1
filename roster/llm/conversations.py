"""Find what is wrong in conversations and repair their structure at the least cost.

Turns of a conversation are rows (conv_id, turn, role, text). A sound one is nothing, or an optional system
turn and then user and assistant in turns, by the initials of the roles: ``(s?(ua)+)?``.

Edits, in the order of the turns: Keep (0), Rerole to user or assistant (2), Delete (3), Insert an empty user
or assistant turn (2). Blank and duplicate turns must be deleted; a truncated turn that stays costs 1. Of the
cheapest rows of edits the one whose initials come first in ASCII is taken.

The search goes through the turns once and keeps, for each of four places in the pattern, the cheapest history
of edits. Histories share their beginnings and are compared by their longest common prefix (``edit_history``).
A shorter history is never a proper beginning of another one of the same cost and the same turns, as any
letter more is an Insert, which costs; so the best beginning of a place stays the best whatever follows.

Rows are dealt by conversation and sorted by Spark; a task reads them as a stream. Whenever all histories
agree on their beginning, that part is decided: its text goes into the digest and is forgotten. So of a long
conversation only a digest of 16 bytes and a letter stay for each turn. One task reads it, since the digest of
its repaired text is a sequence by definition.

Defined results: a NULL role, text or turn counts as one space in the damage key and as role or text; NULL
turns come first and are ignored by ``gaps``. Rows of one turn are taken by role, then text, in byte order.
A role without a first letter has no initial that the pattern takes. A NULL conversation id is a conversation.
Of a conversation without rows all numbers are 0. Extra columns are not carried.
"""

import hashlib
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roster.llm.edit_history import History, less, rebased, shared_beginning

RECHECK = 256  # turns between two looks at what is decided
# Places in the pattern: nothing yet, after system, after user, after assistant.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = {
    (_START, "s"): _SYSTEM,
    (_START, "u"): _USER,
    (_SYSTEM, "u"): _USER,
    (_USER, "a"): _ASSISTANT,
    (_ASSISTANT, "u"): _USER,
}
_REROLED = {_USER: "user", _ASSISTANT: "assistant"}
_RIGHT = {"su", "ua", "au"}
_KEEP, _REROLE, _DELETE, _INSERT = "KRDI"
_REROLE_COST, _DELETE_COST, _INSERT_COST, _TRUNCATED_COST = 2, 3, 2, 1

_GAPS = " \t\n\v\f\r"
_SCHEMA = """conv_id {id}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string,
    repaired_sha256 string"""


def damage_key(conv_id: Column, turn: Column) -> Column:
    """The CRC-32 of ``conv_id:turn``."""
    texts = [F.coalesce(c.cast("string"), F.lit(" ")) for c in (conv_id, turn)]
    return F.crc32(F.concat(texts[0], F.lit(":"), texts[1]))


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with known damage: of 20 keys 0 drops a row, 1 empties it, 2 takes its stops, 3 repeats it, 4 makes it a user's.

    A dropped row stays as ``gone``, without content.
    """
    kind = F.col("kind")
    text = F.when(kind <= 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    filled = turns.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        (damage_key(F.col("conv_id"), F.col("turn")) % 20).alias("kind"),
    )
    copies = F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1)))
    role = F.when(kind == 0, "").when(kind == 4, "user").otherwise(F.col("role"))
    return filled.select("conv_id", "turn", role.alias("role"), text.alias("text"), (kind == 0).alias("gone"), copies.alias("_")).drop("_")


def faults(turns: DataFrame) -> DataFrame:
    """Adds whether a text is blank and whether it breaks off."""
    bare = F.rtrim("text", F.lit(_GAPS))
    return turns.withColumns({"empty": bare == "", "open": ~F.substring(bare, -1, 1).isin(".", "!", "?")})


class _Conversation:
    """What has been read of one conversation."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.turns: list = []  # of the turns: least, most, last, number of different ones
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.initial: str | None = None
        self.seen: set[bytes] = set()
        root = History()
        self.best: list[tuple[int, History] | None] = [(0, root), None, None, None]
        self.rows: deque = deque()  # of the turns that are not decided yet
        self.audit: list[str] = []
        self.place = _START  # of the decided part
        self.sha = hashlib.sha256()
        self.any_text = False
        self._insert()

    def add(self, turn: int | None, role: str, text: str, empty: bool, is_open: bool) -> None:
        if turn is not None:
            if not self.turns:
                self.turns = [turn, turn, turn, 1]
            elif turn != self.turns[2]:
                self.turns = [self.turns[0], turn, turn, self.turns[3] + 1]
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in _RIGHT:
            self.illegal += 1
        self.initial = initial
        content = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
        fault = "blank" if empty else "duplicate" if content in self.seen else "truncated" if is_open else None
        self.seen.add(content)
        if fault:
            setattr(self, fault, getattr(self, fault) + 1)
        self._step(initial, fault)
        self.rows.append((role, text))
        if len(self.rows) % RECHECK == 0:
            self._decide()

    def _offer(self, best: list, place: int, cost: int, before: History, letter: str) -> None:
        """Take a history one letter longer where it is cheaper, or as cheap and first in ASCII."""
        held = best[place]
        if held is not None and held[0] < cost:
            return
        history = History(letter, before)
        if held is None or cost < held[0] or less(history, held[1]):
            best[place] = (cost, history)

    def _step(self, initial: str, fault: str | None) -> None:
        best: list = [None] * 4
        stays = fault not in ("blank", "duplicate")
        extra = _TRUNCATED_COST if fault == "truncated" else 0
        for place, held in enumerate(self.best):
            if held is None:
                continue
            cost, history = held
            self._offer(best, place, cost + _DELETE_COST, history, _DELETE)
            if not stays:
                continue
            after = _NEXT.get((place, initial))
            if after is not None:
                self._offer(best, after, cost + extra, history, _KEEP)
            for letter in "ua":
                after = _NEXT.get((place, letter))
                if after is not None and letter != initial:
                    self._offer(best, after, cost + extra + _REROLE_COST, history, _REROLE)
        self.best = best
        self._insert()
        self._forget_hopeless()

    def _forget_hopeless(self) -> None:
        """Whatever continues a beginning without user turns also continues one that ends with an assistant turn.

        Only a system turn may then have to go. So a dearer beginning is never part of a cheapest repair.
        """
        ended = self.best[_ASSISTANT]
        for place, spared in ((_START, _DELETE_COST), (_SYSTEM, 0)):
            held = self.best[place]
            if held is not None and ended is not None and ended[0] + spared < held[0]:
                self.best[place] = None

    def _insert(self) -> None:
        """Insertions behind each place; two in a row never lead back to a place at the same cost."""
        for _ in range(3):
            before = [held and held[1] for held in self.best]
            for place, held in enumerate(list(self.best)):
                if held is None:
                    continue
                for letter in "ua":
                    after = _NEXT.get((place, letter))
                    if after is not None:
                        self._offer(self.best, after, held[0] + _INSERT_COST, held[1], _INSERT)
            if all((held and held[1]) is old for held, old in zip(self.best, before)):
                break

    def _decide(self) -> None:
        """Write out what all histories share, and forget it."""
        histories = [held[1] for held in self.best if held is not None]
        shared = shared_beginning(histories)
        done = sum(map(len, self.audit))
        if shared.size <= done:
            return
        self._write(shared.letters(done))
        copies = iter(rebased(histories, shared.size)[1])
        self.best = [held and (held[0], next(copies)) for held in self.best]

    def _write(self, letters: str) -> None:
        for letter in letters:
            if letter == _INSERT:
                self._say(self._go("a" if self.place == _USER else "u"), "")
                continue
            role, text = self.rows.popleft()
            if letter == _KEEP:
                self._go(role[:1])
                self._say(role, text)
            elif letter == _REROLE:
                self._say(self._go("a" if self.place == _USER else "u"), text)
        self.audit.append(letters)

    def _go(self, initial: str) -> str | None:
        self.place = _NEXT[self.place, initial]
        return _REROLED.get(self.place)

    def _say(self, role: str | None, text: str) -> None:
        self.sha.update(f"{chr(10) if self.any_text else ''}{role}:{text}".encode())
        self.any_text = True

    def result(self) -> tuple:
        ends = [held for held in (self.best[_START], self.best[_ASSISTANT]) if held is not None]
        cost, history = min(ends, key=lambda held: held[0])
        for other in ends:
            if other[0] == cost and less(other[1], history):
                cost, history = other
        self._write(history.letters(sum(map(len, self.audit))))
        gaps = self.turns[1] - self.turns[0] + 1 - self.turns[3] if self.turns else 0
        faulty = (self.blank, self.duplicate, self.truncated, self.illegal)
        return (self.conv_id, gaps, *faulty, cost, "".join(self.audit), self.sha.hexdigest())


def repair_conversations(turns: DataFrame) -> DataFrame:
    """One row for each conversation of ``turns`` (conv_id, turn, role, text, gone): its faults and its cheapest repair.

    Rows marked ``gone`` only say that there is such a conversation.
    """
    id_type = turns.schema["conv_id"].dataType
    id_arrow = {"string": pa.string()}.get(id_type.simpleString(), pa.int64())
    kept_type = id_type.simpleString() if id_arrow == pa.string() else "long"
    names = [field.split()[0] for field in _SCHEMA.split(",")]
    types = [id_arrow, *[pa.int64()] * 6, pa.string(), pa.string()]

    def repaired(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, done = None, []
        for batch in batches:
            for conv_id, turn, role, text, gone, empty, is_open in zip(*(c.to_pylist() for c in batch.columns)):
                if current is None or current.conv_id != conv_id:
                    if current is not None:
                        done.append(current.result())
                    current = _Conversation(conv_id)
                if not gone:
                    current.add(turn, role, text, empty, is_open)
            if done:
                yield _batch(done, types, names)
                done = []
        if current is not None:
            yield _batch([current.result()], types, names)

    rows = faults(turns).select(
        F.col("conv_id").cast(kept_type).alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text", "gone", "empty", "open"
    )
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(repaired, _SCHEMA.format(id=kept_type))


def _batch(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
