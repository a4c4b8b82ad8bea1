"""Rows of edits that share their beginnings, compared letter by letter in logarithmic time.

A history is a linked node: its last letter, and the history before it. Each node knows the histories 1, 2,
4, ... letters before its own end and a rolling hash of all its letters, so the longest common beginning of
two histories is found by halving. Equal hashes are believed only after the letters have been compared.
"""

_MODULUS = (1 << 61) - 1
_BASE = 0x1F3D5B79A2C4E687 % _MODULUS


class History:
    """Letters up to here; ``up[k]`` is the history without the last 2**k letters."""

    __slots__ = ("letter", "size", "code", "up")

    def __init__(self, letter: str = "", before: "History | None" = None):
        self.letter = letter
        if before is None:
            self.size, self.code, self.up = 0, 0, ()
            return
        self.size = before.size + 1
        self.code = (before.code * _BASE + ord(letter)) % _MODULUS
        up, node, k = [before], before, 0
        while k < len(node.up):
            node = node.up[k]
            up.append(node)
            k += 1
        self.up = tuple(up)

    def cut(self, size: int) -> "History":
        """The history of the first ``size`` letters."""
        node, surplus = self, self.size - size
        while surplus > 0:
            k = surplus.bit_length() - 1
            node = node.up[k]
            surplus -= 1 << k
        return node

    def letters(self, start: int = 0) -> str:
        """The letters from ``start`` on."""
        found, node = [], self
        while node.size > start:
            found.append(node.letter)
            node = node.up[0]
        return "".join(reversed(found))


def common_size(a: History, b: History) -> int:
    """How many letters two histories have in common from their beginning."""
    size = min(a.size, b.size)
    a, b = a.cut(size), b.cut(size)
    if _same(a, b):
        return size
    # Histories before both may be equal; go back in steps that keep them different.
    for k in range(size.bit_length() - 1, -1, -1):
        if k < min(len(a.up), len(b.up)) and not _same(a.up[k], b.up[k]):
            a, b = a.up[k], b.up[k]
    return a.size - 1


def _same(a: History, b: History) -> bool:
    """Whether two histories of one size have the same letters; equal hashes are verified."""
    if a.code != b.code:
        return False
    while a is not b:
        if a.letter != b.letter:
            return False
        a, b = a.up[0], b.up[0]
    return True


def less(a: History, b: History) -> bool:
    """Whether the letters of ``a`` come before those of ``b``; a beginning comes before what continues it."""
    size = common_size(a, b)
    if size == min(a.size, b.size):
        return a.size < b.size
    return a.cut(size + 1).letter < b.cut(size + 1).letter


def shared_beginning(histories: list[History]) -> History:
    """The longest history that all begin with."""
    first = histories[0]
    size = min([first.size, *(common_size(first, other) for other in histories[1:])])
    return first.cut(size)


def rebased(histories: list[History], size: int) -> tuple[History, list[History]]:
    """Copies that no longer hold what lies before the first ``size`` letters, which all have in common.

    Sizes and hashes stay, so copies compare as before; the letters before ``size`` can no longer be read.
    """
    old = histories[0].cut(size)
    root = History()
    root.letter, root.size, root.code = old.letter, old.size, old.code
    copies = {id(old): root}
    out = []
    for history in histories:
        path, node = [], history
        while node.size > size and id(node) not in copies:
            path.append(node)
            node = node.up[0]
        base = copies.get(id(node), root)
        for node in reversed(path):
            base = copies[id(node)] = History(node.letter, base)
        out.append(base)
    return root, out
