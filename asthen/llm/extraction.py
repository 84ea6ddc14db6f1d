"""Main text of web pages: a linear-chain conditional random field over the page's leaf blocks."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asthen.llm.htmltrain import labelled_pages

# HTML's elements by how they lay out (fixed values).
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main "
    "menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead "
    "tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never text of the page.
SKIPPED = frozenset("script style template noscript title textarea iframe svg math object".split())
#: Opening one of these closes an open one of the same group.
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
           "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPES = frozenset("ul ol dl table select body".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*+)((?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[A-Za-z!?][^>]*+(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_TOKEN = re.compile(r"[a-z]+")
_OWNER = re.compile(r"©|\(c\)|\bcopyright\b", re.I)


@dataclass
class Block:
    """A leaf block: its text, the features of its ancestors, and, in training, its label."""

    pieces: list[str] = field(default_factory=list)
    linked: int = 0
    path: frozenset[str] = frozenset()
    tag: str = ""
    main: bool = False
    text: str = ""


@lru_cache(maxsize=20_000)
def _named(tag: str, attributes: str) -> tuple[frozenset[str], str | None]:
    """Features of an element as an ancestor, and its training mark."""
    found, mark = {f"a:{tag}"}, None
    if "=" in attributes:
        for name, *values in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), "".join(values).lower()
            if name in ("class", "id", "role", "itemprop"):
                spaced = re.sub(r"([a-z])([A-Z])", r"\1 \2", "".join(values)).lower()
                found.update(f"n:{t}" for t in _TOKEN.findall(spaced))
            elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                found.add("hidden")
            elif name == "data-main":
                mark = value
    if re.search(r"(?:^|\s)hidden(?:\s|/|$)", attributes):
        found.add("hidden")
    return frozenset(found), mark


def blocks(page: str | None) -> list[Block]:
    """The non-empty leaf blocks of a page in order.

    A block is the text between two borders of block elements; inline elements and br don't end
    it. Character references are decoded, white space becomes one blank. Open p and list or
    table parts are closed as HTML has it, end tags without a start are ignored, and an
    unclosed comment, script or style takes the rest of the page.
    """
    page = page or ""
    out: list[Block] = []
    # an open element: tag, features of it and all above, training mark
    stack: list[tuple[str, frozenset[str], str]] = [("", frozenset(), "0")]
    block, links, at, end = Block(), 0, 0, len(page)

    def text(raw: str) -> None:
        if raw:
            block.pieces.append(raw)
            if links:
                block.linked += len(raw)

    def finish() -> None:
        nonlocal block
        if block.pieces:
            words = html.unescape("".join(block.pieces)).split()
            if words:
                block.text = " ".join(words)
                block.path, block.main = stack[-1][1], stack[-1][2] == "1"
                block.tag = next((t for t, _, _ in reversed(stack) if t in BLOCKS), "")
                out.append(block)
            block = Block()

    def close(upto: int) -> None:
        nonlocal links
        for tag, _, _ in stack[upto:]:
            links -= tag == "a"
        del stack[upto:]

    def last(names: tuple[str, ...], scopes: frozenset[str] = frozenset()) -> int:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in names:
                return i
            if stack[i][0] in scopes:
                break
        return 0

    while at < end:
        match = _MARKUP.search(page, at)
        if not match:
            text(page[at:])
            break
        text(page[at : match.start()])
        at = match.end()
        if match[2] is None:
            continue
        tag = match[2].lower()
        if match[1]:
            i = last((tag,))
            if tag in BLOCKS:
                finish()
            if i:
                close(i)
        elif tag in SKIPPED:
            if tag in ("title", "script", "style", "textarea") or not match[3].endswith("/"):
                over = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                at = over.end() if over else end
            block.pieces.append(" ")
        elif tag in VOID:
            if tag in BLOCKS:
                finish()
            elif tag == "br":
                block.pieces.append(" ")
        else:
            if tag in BLOCKS:
                finish()
                if i := last(("p",), _SCOPES):
                    close(i)
                if tag in _CLOSES and (i := last(_CLOSES[tag], _SCOPES)):
                    close(i)
            elif tag == "a" and (i := last(("a",))):
                close(i)
            names, mark = _named(tag, match[3])
            _, above, marked = stack[-1]
            stack.append((tag, names if names <= above else above | names, mark or marked))
            if names <= above:
                stack[-1] = (tag, above, mark or marked)
            links += tag == "a"
    finish()
    return out


def features(page: list[Block]) -> Iterator[list[str]]:
    """The features of each block: all its ancestors, its own tag, and its text's form."""
    for b in page:
        words = b.text.count(" ") + 1
        out = [*b.path, f"t:{b.tag}", f"words:{min(words, 127).bit_length()}"]
        share = b.linked / max(1, sum(map(len, b.pieces)))
        out.append("links:" + ("all" if share > 0.8 else "some" if share > 0.2 else "few"))
        if b.text[-1] in ".!?…\"'”":
            out.append("ends")
        if _OWNER.search(b.text[:60]):
            out.append("copyright")
        if b.text.count(",") + b.text.count(".") > 2:
            out.append("running")
        out.append("bias")
        yield out


@dataclass
class Field:
    """Weights of a two-label chain: of features for label 1, and of neighbouring labels."""

    weights: dict[str, float]
    steps: np.ndarray  # 2 x 2

    def main(self, page: list[Block]) -> list[bool]:
        """Viterbi: the most likely labels of all blocks together."""
        if not page:
            return []
        weights, back = self.weights, []
        (a, b), (c, d) = self.steps.tolist()
        scores = [sum(weights.get(f, 0.0) for f in fs) for fs in features(page)]
        no, yes = 0.0, scores[0]
        for s in scores[1:]:
            from_no, from_yes = no + a >= yes + c, no + b >= yes + d
            back.append((from_no, from_yes))
            no, yes = (no + a if from_no else yes + c), s + (no + b if from_yes else yes + d)
        label = yes > no
        out = [label]
        for from_no, from_yes in reversed(back):
            label = not (from_yes if label else from_no)
            out.append(label)
        return out[::-1]


def _either(x: np.ndarray, axis: int) -> np.ndarray:
    """log(exp a + exp b) of the two entries along an axis."""
    a, b = x.take(0, axis), x.take(1, axis)
    return np.maximum(a, b) + np.log1p(np.exp(-np.abs(a - b)))


def fit(pages: list[str], rounds: int = 200, rate: float = 0.1, decay: float = 2e-3) -> Field:
    """A field fitted to labelled pages by the exact gradient of the chain's likelihood.

    All pages are padded to one length; forward and backward sums run over all at once.
    """
    parsed = [b for b in map(blocks, pages) if b]
    found = [list(features(b)) for b in parsed]
    counts: dict[str, int] = {}
    for f in (f for page in found for fs in page for f in set(fs)):
        counts[f] = counts.get(f, 0) + 1
    number = {f: i for i, f in enumerate(sorted(f for f, n in counts.items() if n > 2))}
    longest = max(map(len, parsed))
    here = np.arange(longest) < np.array([len(b) for b in parsed])[:, None]
    y = np.zeros(here.shape, int)
    y[here] = [b.main for bs in parsed for b in bs]
    x = np.zeros((here.sum(), len(number)))  # a row for each block, in the order of y[here]
    for row, fs in zip(x, (fs for page in found for fs in page)):
        row[[number[f] for f in fs if f in number]] = 1
    w, steps = np.zeros(len(number)), np.zeros((2, 2))
    both = here[:, 1:]
    real = np.zeros((2, 2))
    np.add.at(real, (y[:, :-1][both], y[:, 1:][both]), 1)
    m, v = np.zeros(len(w) + 4), np.zeros(len(w) + 4)
    for step in range(1, rounds + 1):
        emit = np.zeros((*y.shape, 2))
        emit[here, 1] = x @ w
        ahead, behind = np.zeros_like(emit), np.zeros_like(emit)
        ahead[:, 0] = emit[:, 0]
        for i in range(1, longest):
            new = emit[:, i] + _either(ahead[:, i - 1, :, None] + steps, 1)
            ahead[:, i] = np.where(here[:, i, None], new, ahead[:, i - 1])
        total = _either(ahead[:, -1], 1)
        for i in range(longest - 2, -1, -1):
            new = _either(steps + (emit[:, i + 1] + behind[:, i + 1])[:, None], 2)
            behind[:, i] = np.where(here[:, i + 1, None], new, 0)
        p = np.exp(ahead[..., 1] + behind[..., 1] - total[:, None]) * here
        pair = ahead[:, :-1, :, None] + steps + (emit + behind)[:, 1:, None, :] - total[:, None, None, None]
        expected = (np.exp(np.minimum(pair, 0)) * both[..., None, None]).sum((0, 1))
        grad = np.concatenate([(p - y)[here] @ x, (expected - real).ravel()])
        now = np.concatenate([w, steps.ravel()])
        grad = grad / here.sum() + decay * now / len(parsed)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        now -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, steps = now[:-4], now[-4:].reshape(2, 2)
    return Field({f: float(w[i]) for f, i in number.items()}, steps)


def main_text(model: Field, page: str | None) -> str:
    found = blocks(page)
    return "\n".join(b.text for b, main in zip(found, model.main(found)) if main)


def extract(
    pages: DataFrame,
    training: list[str] | None = None,
    key: str = "page_id",
    url: str = "url",
    page: str = "html",
) -> DataFrame:
    """(key, url, text, n_chars) for every row of `pages`: the main text of the whole page.

    The model is trained here on `training`, labelled pages (by default those of `htmltrain`, 400),
    and sent to the executors; its size is that of its features, not of the data. Blocks
    that the model takes for main text are joined by newlines, in page order.

    A null or empty page, or one without main text, gives an empty text. Null urls stay null; rows
    with repeated or null keys each get their row. Other columns are ignored; an empty table
    gives no rows. Broken markup never fails (`blocks`).
    """
    model = fit(training or labelled_pages())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(model, x.as_py()) for x in batch.column("page")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                names=["key", "url", "text", "n_chars"],
            )

    rows = pages.select(
        F.col(key).cast("long").alias("key"), F.col(url).alias("url"), F.col(page).alias("page")
    )
    out = rows.mapInArrow(run, "key long, url string, text string, n_chars long")
    return out.select(F.col("key").alias(key), F.col("url").alias(url), "text", "n_chars")
