"""HTML text to an array of elements, the one place where Python touches the data."""

from __future__ import annotations

import re
import sys
from bisect import bisect_left
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from courtloom import vocab

# Workers need not have this package installed: the helper below travels with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LINK = "struct<pos:int,tag:string,classes:array<string>,href:string,inner:int>"
ELEMENT = "struct<pos:int,tag:string,parent:string,flags:int,text:string,clean:string>"
ITEM = "struct<pos:int,role:string,label:string,text:string,titled:boolean,in_th:boolean,holds_value:boolean,since:int>"
BLOCK_PARTS = {
    "title": "string",
    "pairs": "array<struct<pos:int,label:string,value:string>>",
    "entries": "array<array<struct<label:string,value:string>>>",
}
CASE_TAGS = ("span", "h5", "h6", "i", "hr")
CASE_CLASSES = (vocab.VALUE_CLASS, *vocab.PROMPT_CLASSES, vocab.IGNORED_CLASS, vocab.STATEMENT_CLASS)
ROLES = ("ignored", "prompt", "value", "break", "other")
# Bits of the case classes, and the vocabulary that the helper below takes along to the workers.
VALUE, PROMPT, IGNORED, STATEMENT = (
    sum(1 << CASE_CLASSES.index(name) for name in names)
    for names in ((vocab.VALUE_CLASS,), vocab.PROMPT_CLASSES, (vocab.IGNORED_CLASS,), (vocab.STATEMENT_CLASS,))
)
BREAK_KINDS, SUBHEADINGS = [CASE_TAGS.index(tag) for tag in vocab.BREAK_TAGS], frozenset(vocab.CHARGE_SUBHEADINGS)
TERMS, NOISE, DEFAULT_TITLE = frozenset(vocab.TERM_PROMPTS), vocab.NOISE_VALUE, vocab.DEFAULT_TITLE
ANCHORS = TERMS | {"Article", "Event Type"}

# Fixed values of HTML: elements that never hold content, and elements whose text is not page text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("template rt rp".split())

# One token: script or style with its whole body, comment or declaration, or a start or end tag.
TOKEN = re.compile(
    r"""<(?P<raw>script|style)\b[^>]*>.*?(?:</(?P=raw)[^>]*>|\Z)
    |<!--.*?(?:-->|\Z)
    |<[!?][^>]*>
    |<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)
      (?P<attrs>(?:[\s/]++|[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*"|'[^']*'|[^\s>]*+))?|=)*+)>""",
    re.S | re.I | re.X,
)
# The same tokens in one group, to cut a page at them.
TOKENS = re.compile(
    r"""(</[a-z0-9]+>
    |<script\b[^>]*>.*?(?:</script[^>]*>|\Z)
    |<style\b[^>]*>.*?(?:</style[^>]*>|\Z)
    |<!--.*?(?:-->|\Z)
    |<[!?][^>]*>
    |</?[a-z][^\s/>]*
      (?:[\s/]++|[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*"|'[^']*'|[^\s>]*+))?|=)*+>)""",
    re.S | re.I | re.X,
)
# The inside of a tag that ends at the next bracket wherever it stands: no quotes but around whole values.
PLAIN = re.compile(
    r"""/[a-z][^\s"'<=/]*+\s*+
    |(?!(?:script|style)\b)[a-z][^\s"'<=/]*+(?:\s++[^\s"'<=/]++(?:="[^"<]*+"|=[^\s"'<=]++)?)*+\s*+/?""",
    re.I | re.X,
)
DIGITS = re.compile("[0-9]+")
LONG_TOKEN = 256
MANY_PIECES = 1 << 14
ENDED = re.compile(r"-->\Z|^<[!?](?!--)|</(?:script|style)[^>]*>\Z", re.I)
ATTRIBUTE = re.compile(r"""([^\s/>=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")


def attribute(attrs: str, wanted: str) -> str | None:
    values = {name.lower(): a or b or c for name, a, b, c in ATTRIBUTE.findall(attrs)}
    return unescape(values[wanted]) if wanted in values else None


def class_list(attrs: str) -> tuple[str, ...]:
    return tuple((attribute(attrs, "class") or "").split())


def read_token(token: str) -> tuple[str | None, str | None, str | None, bool]:
    """`(tag, closing, attrs, holds)` of a token; no tag for scripts, styles, comments and declarations.

    `holds` says that a start tag opens an element that may have content.
    """
    _, closing, tag, attrs = TOKEN.match(token).groups()
    tag = tag and tag.lower()
    return tag, closing, attrs, not closing and tag not in VOID and (attrs or "")[-1:] != "/"


def read_head(head: str, wanted: frozenset, classes_of, read) -> tuple | None:
    """`(tag, closing, classes, holds)` of the inside of a tag.

    None where only the page says how far the token goes: scripts, comments, stray brackets, odd quotes.
    """
    if len(head) > LONG_TOKEN or not PLAIN.fullmatch(head):
        return None
    tag, closing, attrs, holds = read(f"<{head}>")
    return tag, closing, classes_of(attrs) if tag in wanted and not closing else None, holds


def walk(html: str, wanted: frozenset, classes_of, read, known: dict | None = None) -> tuple[list, list, list, list, list]:
    """A page's wanted elements in document order, as columns: tags, parents, classes, texts, and ends in that order.

    An end tag closes up to its nearest open match and is ignored without one.
    The text of an element is a run of the page's text chunks, so nesting costs nothing.
    The page is cut at its brackets; pieces, each a tag and the text behind it, repeat from page to page.
    `known` holds those met, and insides of tags behind a bracket, which no piece has; kept between pages of one `wanted`, `classes_of`
    and `read`, it spares most of the reading.
    """
    known = {} if known is None else known
    chunks, names, marks, silent = [], [], [], 0
    tags, parents, classes, starts, stops, ends = [], [], [], [], [], []
    still_open: dict[str, int] = {}
    # No tag ends after the last bracket: looking no further keeps a page of unended tags linear.
    limit = html.rfind(">") + 1
    pieces = html.split("<")
    count, k = len(pieces), 1
    # The bracket before piece `placed` stands at `place`.
    placed, place = 1, len(pieces[0])
    if pieces[0]:
        chunks.append(unescape(pieces[0]))
    while k < count:
        piece = pieces[k]
        found = known.get(piece)
        if found is None:
            head, bracket, text = piece.partition(">")
            inside = f"<{head}"
            if bracket:
                found = known.get(inside) or read_head(head, wanted, classes_of, read)
            if found:
                if len(known) >= MANY_PIECES:
                    known.clear()
                known[inside] = found
                found = (unescape(text) if "&" in text else text, *found)
                if len(piece) <= LONG_TOKEN:
                    known[piece] = found
        if found:
            text, tag, closing, listed, holds = found
            k += 1
        else:
            place += sum(map(len, pieces[placed:k])) + k - placed
            token = TOKENS.match(html, place, limit) if place < limit else None
            k += 1
            end = place + 1 + len(piece)
            if token is None:
                if not silent:
                    chunks.append(unescape(html[place:end]))
                placed, place = k, end
                continue
            token, stop = token.group(), token.end()
            while end < stop:
                end += 1 + len(pieces[k])
                k += 1
            placed, place = k, end
            tag, closing, attrs, holds = read(token) if len(token) <= LONG_TOKEN else read_token(token)
            listed = classes_of(attrs) if tag in wanted and not closing else None
            text = unescape(html[stop:end])
            if tag is None and stop == limit and not ENDED.search(token):
                text, k = "", count
        if closing:
            if still_open.get(tag):
                name = None
                while name != tag:
                    name, mark = names.pop(), marks.pop()
                    still_open[name] -= 1
                    if mark is not None:
                        stops[mark], ends[mark] = len(chunks), len(tags)
                    elif name in SILENT:
                        silent -= 1
        elif tag is not None:
            mark = None
            if tag in wanted:
                mark = len(tags)
                tags.append(tag)
                parents.append(names[-1] if names else None)
                classes.append(listed)
                starts.append(len(chunks))
                stops.append(len(chunks))
                ends.append(mark + 1)
            if holds:
                names.append(tag)
                marks.append(mark)
                still_open[tag] = still_open.get(tag, 0) + 1
                if mark is None and tag in SILENT:
                    silent += 1
        if text and not silent:
            chunks.append(text)
    for mark in marks:
        if mark is not None:
            stops[mark], ends[mark] = len(chunks), len(tags)
    texts = [chunks[a] if b - a == 1 else "".join(chunks[a:b]) for a, b in zip(starts, stops)]
    return tags, parents, classes, texts, ends


def page_elements(html: str, wanted: frozenset, classes_of=class_list, nested=False, read=read_token) -> list[tuple]:
    """`(tag, parent, classes, text)` of a page's wanted elements, in document order.

    With `nested`, also how many wanted elements each one holds.
    """
    *found, ends = walk(html, wanted, classes_of, read)
    if nested:
        return list(zip(*found, (end - at - 1 for at, end in enumerate(ends))))
    return list(zip(*found))


def walk_pages(pages: list, listed: str, wanted: frozenset) -> tuple[list, list, list, list, list, list, list]:
    """`(ends, absent, pos, tags, parents, flags, texts)` of a batch of pages, the elements of all pages in a row."""
    bits = {name: 1 << i for i, name in enumerate(listed.split())}
    flags_of = lru_cache(4096)(lambda attrs: sum(bits.get(name, 0) for name in set(class_list(attrs))))
    read = lru_cache(4096)(read_token)
    known: dict[str, tuple] = {}
    ends, absent, pos, columns = [0], [], [], ([], [], [], [])
    for source in pages:
        absent.append(source is None)
        if source:
            *found, _ = walk(source, wanted, flags_of, read, known)
            pos.extend(range(len(found[0])))
            for column, values in zip(columns, found):
                column.extend(values)
        ends.append(len(pos))
    return ends, absent, pos, *columns


def html_elements(html: str | Column, tags=CASE_TAGS, classes=CASE_CLASSES) -> Column:
    """Array of the wanted elements of a page in document order, nested ones included.

    Arrow batches go in and out; only the html column crosses to Python.  `text`
    is the inner text, `clean` the same with blanks collapsed; bit i of `flags`
    says that the element has the i-th of `classes`.  The call is marked
    as non-deterministic so that no filter on its result is pushed below it, which
    would walk every page twice.
    """
    wanted = frozenset(tags)

    @F.arrow_udf(f"array<{ELEMENT}>")
    def explode_html(pages: pa.Array, listed: pa.Array) -> pa.Array:
        ends, absent, pos, tag, parent, flags, text = walk_pages(
            pages.to_pylist(), listed[0].as_py() if len(listed) else "", wanted
        )
        rows = pa.StructArray.from_arrays(
            [
                pa.array(pos, pa.int32()),
                pa.array(tag, pa.string()),
                pa.array(parent, pa.string()),
                pa.array(flags, pa.int32()),
                pa.array(text, pa.string()),
                pa.array([" ".join(x.split()) for x in text], pa.string()),
            ],
            names=["pos", "tag", "parent", "flags", "text", "clean"],
        )
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows, mask=pa.array(absent))

    return explode_html.asNondeterministic()(html, F.lit(" ".join(classes)))


def prompt_text(text: str, clean: str) -> str:
    """Label of a prompt, as `functions.text.prompt_label` reads it."""
    marks = 2 if text.endswith("?:") else 1 if text.endswith((":", "?")) else 0
    return clean[: max(len(clean) - marks, 0)].strip(" ")


def html_items(html: str | Column) -> Column:
    """The elements of a case page as `operators.blocks.items` reads them, made where the page is walked.

    Roles, labels and places of the latest prompt are array operations over a whole
    Arrow batch, so only what the parse reads on goes back to Spark.
    """
    wanted = frozenset(CASE_TAGS)

    @F.arrow_udf(f"array<{ITEM}>")
    def explode_items(pages: pa.Array, listed: pa.Array) -> pa.Array:
        ends, absent, pos, tags, parents, flags, texts = walk_pages(
            pages.to_pylist(), listed[0].as_py() if len(listed) else "", wanted
        )
        cleans = [" ".join(text.split()) for text in texts]
        marks, kinds = np.array(flags, "int64"), np.array([CASE_TAGS.index(tag) for tag in tags], "int64")
        breaks = np.isin(kinds, BREAK_KINDS) & (marks & STATEMENT == 0)
        for at in np.flatnonzero(breaks & (kinds == CASE_TAGS.index("i"))).tolist():
            breaks[at] = parents[at] != "left" or cleans[at] not in SUBHEADINGS
        roles = np.select([marks & bits != 0 for bits in (IGNORED, PROMPT, VALUE)] + [breaks], range(4), 4)
        label_of = lru_cache(4096)(prompt_text)
        labels = [None] * len(tags)
        for at in np.flatnonzero(roles == 1).tolist():
            labels[at] = label_of(texts[at], cleans[at])
        # The latest prompt at or before each element, unless it lies on an earlier page.
        latest = np.maximum.accumulate(np.where(roles == 1, np.arange(len(tags)), -1)) if tags else marks
        firsts = np.repeat(np.array(ends[:-1], "int64"), np.diff(ends))
        rows = pa.StructArray.from_arrays(
            [
                pa.array(pos, pa.int32()),
                pa.array(ROLES, pa.string()).take(pa.array(roles, pa.int32())),
                pa.array(labels, pa.string()),
                pa.array(cleans, pa.string()),
                pa.array(kinds != CASE_TAGS.index("hr")),
                pa.array([parent == "th" for parent in parents], pa.bool_()),
                pa.array(marks & VALUE != 0),
                pa.array(latest - firsts, pa.int32(), mask=latest < firsts),
            ],
            names=["pos", "role", "label", "text", "titled", "in_th", "holds_value", "since"],
        )
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows, mask=pa.array(absent))

    return explode_items.asNondeterministic()(html, F.lit(" ".join(CASE_CLASSES)))


def whole(digits: str) -> int | None:
    """Number of a text of digits, None beyond 32 bits."""
    number = int(digits[-11:]) if not digits[:-11].strip("0") else 1 << 31
    return number if number < 1 << 31 else None


def term_of(years: str, months: str, days: str, hours: str) -> str | None:
    """A term as `functions.values.term_text` writes it, from its texts."""
    y, m, d, h = (part or "0" for part in (years, months, days, hours))
    if DIGITS.fullmatch(y) and DIGITS.fullmatch(m) and (whole(m) or 0) > 12:
        y, over = whole(y), whole(m) // 12
        if y is None or whole(str(y + over)) is None:
            return None
        y, m = y + over, whole(m) % 12
    return f"{y}-{m} {d} {h}:00:00"


def page_spans(anchors, labels, texts, in_th, holds, start: int, end: int, extra: int):
    """`(start, stop, label, key, text, rows)` of the look-ahead reads that fire on a page's items `[start, end)`.

    As `operators.blocks.spans` and `keep_spans` find them: a read that starts inside an earlier one does not fire.
    Rows map labels to values: the last value of a label, at the place of its first use.
    """
    free = start
    for i in anchors:
        label = labels[i]
        if i < free:
            continue
        if label in TERMS:
            text = term_of(*[texts[i + n] for n in (2, 4, 6, 8)]) if i + 8 < end else None
            free = i + 9
            yield i, free, label, label, text, []
        elif label == "Article" and i + 2 < end and texts[i + 2] == "Sec:":
            parts = [texts[i + n] for n in range(1, 10, 2) if holds[i + n]] if i + 9 < end else None
            free = i + 10 + extra
            yield i, free, label, "Statute Code", None if parts is None else ".".join(filter(None, parts)), []
        elif label == "Event Type" and in_th[i]:
            body = next((at for at in range(i, end) if not in_th[at]), end)
            stop = next((at for at in range(body, end) if not holds[at]), end)
            names, cells = texts[i:body], texts[body:stop]
            rows = [dict(zip(names, cells[at : at + len(names)])) for at in range(0, len(cells), len(names))]
            free = stop + extra if stop < end else stop
            yield i, free, label, None, None, rows


def live_items(stay, under, labels, texts, spans, start: int, end: int):
    """`(at, label, span)` of a page's values and breaks outside its spans, and of the spans, in page order.

    The label is that of the latest prompt; prompts inside a span are gone with it, so the span's own holds behind it.
    """
    first, held = start, None
    for span in [*spans, None]:
        stop = span[0] if span else end
        for at in stay[bisect_left(stay, first) : bisect_left(stay, max(stop, first))]:
            prompt = under[at]
            yield at, labels[prompt] if prompt >= first else held, None
        if span:
            yield span[0], span[2], span
            first, held = span[1], span[2]


def read_blocks(items: Column, lossy_skips: bool = False, parts=tuple(BLOCK_PARTS)) -> Column:
    """Titled blocks of a page's items, as `operators.blocks` builds them from spans, live items and titles.

    On items that `html_items` makes, both steps run in one pass of the worker and the items never leave it.
    """
    extra, parts = 1 if lossy_skips else 0, tuple(parts)

    @F.arrow_udf(f"array<struct<{','.join(f'{part}:{BLOCK_PARTS[part]}' for part in parts)}>>")
    def build_blocks(pages: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.list_value_length(pages), 0).to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype("int64")
        fields = pages.flatten()
        column = lambda name: fields.field(name).to_numpy(zero_copy_only=False)
        roles = pc.index_in(fields.field("role"), value_set=pa.array(ROLES)).to_numpy(zero_copy_only=False)
        since = pc.fill_null(fields.field("since"), -1).to_numpy(zero_copy_only=False)
        under = np.where(since < 0, -1, since + np.repeat(ends[:-1], sizes)).tolist()
        opening = np.zeros(len(roles), bool)
        opening[ends[:-1][sizes > 0]] = True
        stays = np.flatnonzero((roles == 2) | (roles == 3) | opening)
        labels, texts = column("label").tolist(), column("text").tolist()
        marked = [at for at, label in enumerate(labels) if label in ANCHORS]
        in_th, holds = (column("in_th").tolist(), column("holds_value").tolist()) if marked else ([], [])
        is_value, is_title = (roles == 2).tolist(), ((roles == 3) & column("titled").astype(bool)).tolist()
        breaks = (roles == 3).tolist()

        titles, block_ends = [], [0]
        pair_ends, places, pair_labels, pair_values = [0], [], [], []
        entry_ends, cell_ends, cell_labels, cell_values = [0], [0], [], []

        def close(rows: list) -> None:
            first = pair_ends[-1]
            pair_ends.append(len(places))
            if first < len(places):
                rows = [*rows, dict(zip(pair_labels[first:], pair_values[first:]))]
            for row in rows:
                cell_labels.extend(row)
                cell_values.extend(row.values())
                cell_ends.append(len(cell_labels))
            entry_ends.append(len(cell_ends) - 1)

        for start, end in zip(ends[:-1].tolist(), ends[1:].tolist()):
            stay = stays[np.searchsorted(stays, start) : np.searchsorted(stays, end)].tolist()
            anchors = marked[bisect_left(marked, start) : bisect_left(marked, end)]
            spans = list(page_spans(anchors, labels, texts, in_th, holds, start, end, extra)) if anchors else ()
            title, rows = DEFAULT_TITLE, None
            for at, label, span in live_items(stay, under, labels, texts, spans, start, end):
                if rows is None or not span and breaks[at]:
                    if rows is not None:
                        close(rows)
                    title, rows = not span and is_title[at] and texts[at] or title, []
                    titles.append(title)
                if span:
                    rows += span[5]
                    label, text, paired = span[3], span[4], span[3] is not None
                else:
                    text = texts[at]
                    paired = is_value[at] and label and text != NOISE
                if paired:
                    places.append(at - start)
                    pair_labels.append(label)
                    pair_values.append(text)
            if rows is not None:
                close(rows)
            block_ends.append(len(titles))

        texts_of = lambda values: pa.array(values, pa.string())
        lists = lambda at, values: pa.ListArray.from_arrays(pa.array(at, pa.int32()), values)
        structs = lambda **columns: pa.StructArray.from_arrays(list(columns.values()), names=list(columns))
        cells = structs(label=texts_of(cell_labels), value=texts_of(cell_values))
        pairs = lambda: structs(pos=pa.array(places, pa.int32()), label=texts_of(pair_labels), value=texts_of(pair_values))
        made = {
            "title": lambda: texts_of(titles),
            "pairs": lambda: lists(pair_ends, pairs()),
            "entries": lambda: lists(entry_ends, lists(cell_ends, cells)),
        }
        found = structs(**{part: made[part]() for part in parts})
        return pa.ListArray.from_arrays(pa.array(block_ends, pa.int32()), found, mask=pages.is_null())

    return build_blocks.asNondeterministic()(items)


def html_links(html: str | Column, holders=("table", "span")) -> Column:
    """Array of a page's anchors and of the elements that may hold them, in document order.

    `inner` counts the listed elements nested inside: an anchor at `p` lies in the
    element at `q` when `q < p <= q + inner`.
    """
    wanted = frozenset(holders) | {"a"}

    @F.arrow_udf(f"array<{LINK}>")
    def list_links(pages: pa.Array) -> pa.Array:
        rows = []
        for page in pages:
            source = page.as_py()
            found = page_elements(source or "", wanted, lambda attrs: (attrs,), nested=True)
            rows.append(
                None
                if source is None
                else [
                    {
                        "pos": at,
                        "tag": tag,
                        "classes": class_list(attrs),
                        "href": attribute(attrs, "href") if tag == "a" else None,
                        "inner": inner,
                    }
                    for at, (tag, _, (attrs,), _, inner) in enumerate(found)
                ]
            )
        texts = pa.list_(pa.string())
        link = pa.struct(
            [("pos", pa.int32()), ("tag", pa.string()), ("classes", texts), ("href", pa.string()), ("inner", pa.int32())]
        )
        return pa.array(rows, pa.list_(link))

    return list_links.asNondeterministic()(html)
