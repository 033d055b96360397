"""Union-free wrappers of pages: sequences of elements, optional items, repeated groups, text slots.

A page's token stream is aligned with the wrapper found so far. Equal tokens stay; text meets text
in a slot; other mismatches are resolved without alternatives:
* items that repeat in sequence become one repeated item, or a repeated group of up to ``PERIOD``;
* items that only one side has become optional.
Alignment is by longest common subsequence of labels, element by element, so nesting is kept.
"""

from __future__ import annotations

import json

import numpy as np

from .page_tokens import TEXT, Item

#: Longest repeated group that is looked for.
PERIOD = 4
#: Cells of one alignment table; longer sequences are first cut at labels both have once.
CELLS = 1 << 22


def _group(items: list[Item]) -> Item:
    return Item("(" + " ".join(i.label for i in items) + ")", kids=items)


def _joined(a: Item, b: Item, rep: bool, opt: bool) -> Item:
    """Two occurrences of one label as one item."""
    if not a.kids and not b.kids:
        kids = []
    elif len(a.kids) == 1 == len(b.kids) and a.kids[0].label == TEXT == b.kids[0].label:
        x, y = a.kids[0], b.kids[0]
        kids = [Item(TEXT, x.opt or y.opt, x.rep or y.rep, marks=x.marks + y.marks)]
    else:
        kids = align(a.kids, b.kids)
    return Item(a.label, opt, rep, kids, a.marks + b.marks if a.marks or b.marks else None)


def fold(items: list[Item]) -> list[Item]:
    """Repeats in sequence as repeated items and groups; below, items are folded already."""
    out: list[Item] = []
    for item in items:
        if out and out[-1].label == item.label:
            out[-1] = _joined(out[-1], item, True, out[-1].opt and item.opt)
        else:
            out.append(item)
    if len(out) < 4:
        return out
    for period in range(2, PERIOD + 1):
        k, found = 0, []
        while k < len(out):
            names = [i.label for i in out[k : k + period]]
            n = 1
            while len(names) == period and [i.label for i in out[k + n * period : k + (n + 1) * period]] == names:
                n += 1
            if n < 2:
                found.append(out[k])
                k += 1
                continue
            whole = _group(out[k : k + period])
            for m in range(1, n):
                whole = _joined(whole, _group(out[k + m * period : k + (m + 1) * period]), True, False)
            found.append(whole)
            k += n * period
        if len(found) < len(out):
            return fold(found)
    return out


def fold_page(node: Item) -> Item:
    """A page's tree with every repeat folded."""
    if node.kids:
        node.kids = fold([fold_page(k) if k.kids else k for k in node.kids])
    return node


def _grouped(items: list[Item], other: list[Item]) -> list[Item]:
    """Items with runs that match a group of the other side put into that group."""
    mine = {i.label for i in items}
    groups = [g for g in other if g.label[:1] == "(" and g.label not in mine]
    for group in groups:
        names, k, out = [i.label for i in group.kids], 0, []
        while k < len(items):
            if [i.label for i in items[k : k + len(names)]] == names:
                found = _group(items[k : k + len(names)])
                found.label = group.label
                out.append(found)
                k += len(names)
            else:
                out.append(items[k])
                k += 1
        items = out
    return items


def _common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of places of a longest common subsequence; both ends first, so most tables are small."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    pairs = [(k, k) for k in range(head)]
    if x and y:
        pairs += [(head + i, head + j) for i, j in (_table(x, y) if len(x) * len(y) <= CELLS else _split(x, y))]
    return pairs + [(len(a) - t, len(b) - t) for t in range(tail, 0, -1)]


def _table(x: list[str], y: list[str]) -> list[tuple[int, int]]:
    number: dict[str, int] = {}
    p = np.array([number.setdefault(v, len(number)) for v in x])
    q = np.array([number.setdefault(v, len(number)) for v in y])
    best = np.zeros((len(x) + 1, len(y) + 1), np.int32)
    for i in range(len(x) - 1, -1, -1):
        row = np.maximum(best[i + 1, :-1], best[i + 1, 1:] + (q == p[i]))
        best[i, :-1] = np.maximum.accumulate(row[::-1])[::-1]
    pairs, i, j = [], 0, 0
    while i < len(x) and j < len(y):
        if p[i] == q[j]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1, j] >= best[i, j + 1]:
            i += 1
        else:
            j += 1
    return pairs


def _split(x: list[str], y: list[str]) -> list[tuple[int, int]]:
    """Long sequences: halves of the longer one, the other cut where the label in the middle is nearest."""
    if len(x) < len(y):
        return [(i, j) for j, i in _split(y, x)]
    middle = len(x) // 2
    near = [j for j, v in enumerate(y) if v == x[middle]]
    cut = min(near, key=lambda j: abs(j * len(x) - middle * len(y))) if near else len(y) // 2
    right = _common(x[middle:], y[cut:])
    return _common(x[:middle], y[:cut]) + [(middle + i, cut + j) for i, j in right]


def align(a: list[Item], b: list[Item]) -> list[Item]:
    """The sequences of two occurrences as one sequence that covers both."""
    a, b = _grouped(a, b), _grouped(b, a)
    out: list[Item] = []
    i = j = 0
    for m, n in [*_common([x.label for x in a], [x.label for x in b]), (len(a), len(b))]:
        for item in a[i:m] + b[j:n]:
            out.append(Item(item.label, True, item.rep, item.kids, item.marks))
        if m < len(a):
            x, y = a[m], b[n]
            if x.label == TEXT:
                out.append(Item(TEXT, x.opt or y.opt, x.rep or y.rep, marks=x.marks + y.marks))
            else:
                out.append(_joined(x, y, x.rep or y.rep, x.opt or y.opt))
        i, j = m + 1, n + 1
    return fold(out)


def slots(node: Item, path: tuple[str, ...] = ()) -> list[tuple[Item, tuple[str, ...]]]:
    """The text slots in order, with the labels above each."""
    out = []
    for kid in node.kids:
        if kid.label == TEXT:
            out.append((kid, path))
        elif kid.kids:
            out += slots(kid, path if kid.label[:1] == "(" else (*path, kid.label))
    return out


def dump(node: Item) -> str:
    """The wrapper as text, equal for equal structures."""

    def plain(i: Item) -> list:
        return [i.label, int(i.opt) + 2 * int(i.rep), *(plain(k) for k in i.kids)]

    return json.dumps([plain(k) for k in node.kids], ensure_ascii=False, separators=(",", ":"))


def load(text: str, mark: str = "") -> Item:
    """A wrapper from its text; slot k is marked (mark, k)."""
    n = 0

    def item(x: list) -> Item:
        nonlocal n
        out = Item(x[0], bool(x[1] & 1), bool(x[1] & 2))
        if x[0] == TEXT:
            out.marks = [(mark, n)]
            n += 1
        else:
            out.kids = [item(k) for k in x[2:]]
        return out

    return Item("", kids=[item(x) for x in json.loads(text)])


def merged(wrappers: list[str]) -> str:
    """One wrapper of all, aligned one after the other in the order given."""
    out = load(wrappers[0])
    for text in wrappers[1:]:
        out = Item("", kids=align(out.kids, load(text).kids))
        for slot, _ in slots(out):
            slot.marks = []
    return dump(out)


def _flat(items: list[Item]) -> list[Item]:
    """Items with groups replaced by what one pass through them holds."""
    return [x for i in items for x in (_flat(i.kids) if i.label[:1] == "(" else [i])]


def _meet(wrapper: list[Item], page: list[Item], out: list[int | None]) -> None:
    """Mark in ``out`` the wrapper's slot for every text slot of a page's sequence.

    What the alignment leaves open is a further turn of a repeat: it meets the nearest item of its label.
    """
    a, b = _flat(wrapper), _flat(page)
    met = dict((j, i) for i, j in _common([x.label for x in a], [x.label for x in b]))
    places: dict[str, list[int]] = {}
    for i, item in enumerate(a):
        places.setdefault(item.label, []).append(i)
    last = 0
    for j, item in enumerate(b):
        if j in met:
            last = met[j]
        elif item.label in places:
            met[j] = min(places[item.label], key=lambda i: abs(i - last))
        else:
            continue
        mine = a[met[j]]
        if item.label == TEXT:
            for _, k in item.marks:
                out[k] = mine.marks[0][1]
        elif item.kids:
            _meet(mine.kids, item.kids, out)


def matched(wrapper: str, page: str) -> list[int | None]:
    """For each slot of a page's shape the slot of the wrapper that it meets."""
    shape = load(page, "p")
    out: list[int | None] = [None] * len(slots(shape))
    _meet(load(wrapper, "w").kids, shape.kids, out)
    return out


def kept_slots(wrapper: str, keep: str, page: str) -> list[bool]:
    """Which slots of a page's shape the wrapper keeps (``keep``: 0 or 1 per wrapper slot).

    A slot that the wrapper has no place for is kept where one with the same labels above it is.
    """
    above = {path for (_, path), k in zip(slots(load(wrapper)), keep, strict=True) if k == "1"}
    own = zip(matched(wrapper, page), slots(load(page)), strict=True)
    return [keep[k] == "1" if k is not None else path in above for k, (_, path) in own]
