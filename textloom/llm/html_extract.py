"""Operator 1: main text of HTML pages by two-pass block rules.

The markup is cut at block-level tags into blocks. A block in a region that its element names as furniture (menus,
headers, footers, sidebars, notices, adverts, forms, comments, hidden parts) is no candidate. A class or id names furniture
by a whole token (site-header, nav-wrapper, but not has-sidebar); it doesn't hide an article or main below, and where it
leaves neither an article or main nor a block that the first pass calls text, the blocks it hid are candidates. The first pass decides
the other blocks by link density, length and stop-word density; in the second, ambiguous blocks inherit the label of
their nearest decided neighbours. Blocks inside article or main elements start from the belief that they are text, and
ambiguous blocks outside, on a page that has such elements, from the belief that they aren't; decided blocks stay decided.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm._common import bounded_batches, load

SHORT = 70  # characters
MANY_STOPS = 0.30
SOME_STOPS = 0.15
MANY_LINKS = 0.5

# Frequent function words of the languages expected.
STOPS = frozenset(
    """a about after all also an and are as at be been but by can for from had has have he her his if in into is it its more not of
    on one or our she so some such than that the their there they this to was we were what when which who will with would you
    au aux avec ce ces dans de des du elle en est et eux il ils je la le les leur lui mais ne nous on ou par pas pour qu que qui
    sa se ses son sont sur un une vous y
    aber als am auch auf aus bei bin das dass dem den der des die durch ein eine einem einen einer er es für hat ich ihr im ist
    mit nach nicht noch nur oder sich sie sind so über um und uns vom von vor war wie wir zu zum zur
    al como con cuando del desde donde el ella entre era es esta este fue ha hay la las lo los más me mi muy no nos o para pero
    por porque que se sin sobre su sus también te un una y ya""".split()
)
# Elements by their role in HTML.
BLOCKS = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot
    th thead title tr ul head""".split()
)
CONTAINERS = frozenset("article aside blockquote body details dialog dir div dl fieldset figure footer form header html li main menu nav ol search section table ul td tr tbody head button select h1 h2 h3 h4 h5 h6 p span label".split())
RAW = frozenset("script style noscript template textarea svg iframe object math canvas audio video title xmp noembed noframes".split())
FURNITURE = frozenset("nav footer aside form dialog menu button select search head fieldset".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
BAD_NAMES = frozenset(
    """ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment comments consent cookie
    cookies copyright discussion disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice
    overlay pager pagination paywall popup promo promoted promotion reader replies reply respond related search share sharing
    sidebar signup skip social sponsor sponsored subscribe subscription tags toolbar tracking widget""".split()
)
# Words before or after the name of a part that leave its role, and words that make a token tell of something else.
BOXES = frozenset("area banner bar block bottom box container group inner item items left links list main outer panel right row section slot top unit wrap wrapper zone".split())
OTHERS = frozenset("above after article before below body content entry has hide is layout no non not page post show story under with without".split())
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
TAG = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^"'>]|"[^"]*"|'[^']*')*+)>""", re.S)
OPEN_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
QUOTED = 1024  # characters in which a tag's quoted attributes are looked for; a longer tag ends at its first >
ATTR = re.compile(r"""([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
WORD = re.compile(r"[^\W\d_]+")


NAMED, SURE = 1, 2


def next_tag(page: str, lt: int, last: int) -> tuple[int, bool, str, str] | None:
    """(end, closing, name, attributes) of the tag, comment or declaration at page[lt]; the name of the latter two is empty.
    None if it is text. last is the place of the page's last >, so that the time is bounded by QUOTED and the tag's length."""
    if page.startswith("<!--", lt):
        end = page.find("-->", lt + 4)
        return (end + 3 if end >= 0 else len(page)), False, "", ""
    if lt > last:
        return None
    if page.startswith(("<!", "<?"), lt):
        return page.find(">", lt) + 1, False, "", ""
    m = TAG.match(page, lt, lt + QUOTED)
    if m:
        return m.end(), bool(m[1]), m[2].lower(), m[3]
    m = OPEN_TAG.match(page, lt)
    end = page.find(">", lt)
    return (end + 1, bool(m[1]), m[2].lower(), page[m.end() : end]) if m else None


class Block:
    __slots__ = ("parts", "links", "trusted", "bad", "heading")

    def __init__(self, trusted: bool, bad: int, heading: bool):
        self.parts: list[str] = []
        self.links = 0
        self.trusted, self.bad, self.heading = trusted, bad, heading


def _names_furniture(token: str, allowed: set[str]) -> bool:
    """Whether a class or id token is the name of a furniture element, boxes around it included."""
    parts = [x.lower() for x in NAME.findall(token) if len(x) > 1]
    if any(x in OTHERS for x in parts):
        return False
    while len(parts) > 1 and parts[-1] in BOXES and parts[-1] not in BAD_NAMES:
        parts.pop()
    return bool(parts) and parts[-1] in BAD_NAMES - allowed


def _furniture(tag: str, attrs: str, trusted: bool) -> int:
    """0 for no furniture, NAMED for an element that only its class or id names so, SURE for others."""
    if tag in FURNITURE or (tag == "header" and not trusted):
        return SURE
    named = 0
    for m in ATTR.finditer(attrs) if attrs.strip() else ():
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return SURE
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return SURE
        if key == "role" and value.lower() in ROLES:
            return SURE
        if key in ("class", "id") and tag not in ("html", "body"):
            if any(_names_furniture(x, {"header", "tags"} if trusted else set()) for x in value.split()):
                named = NAMED
    return named


def blocks(page: str) -> list[Block]:
    """The page's blocks with text, in order."""
    found: list[Block] = []
    stack: list[tuple[str, bool, int]] = []  # tag, trusted and bad from here on
    trusted, bad = False, 0
    link = 0
    heading = False
    now = Block(False, 0, False)

    def text(s: str) -> None:
        if s:
            s = html.unescape(s) if "&" in s else s
            now.parts.append(s)
            if link:
                now.links += len(s.strip())

    def cut() -> None:
        nonlocal now
        if now.parts:
            found.append(now)
        now = Block(trusted, bad, heading)

    at, n, last = 0, len(page), page.rfind(">")
    depth: Counter = Counter()  # open elements by name
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            text(page[at:])
            break
        found_tag = next_tag(page, lt, last)
        if found_tag is None:
            end = page.find("<", lt + 1)
            text(page[at : end if end >= 0 else n])
            at = end if end >= 0 else n
            continue
        text(page[at:lt])
        at, closing, tag, attrs = found_tag
        if not tag:
            continue
        if tag in RAW and not closing:
            if attrs.endswith("/") and tag in ("svg", "math"):
                continue
            end = re.compile(rf"</{tag}\b", re.I).search(page, at)
            at = page.find(">", end.end()) + 1 if end else 0
            at = at or n
            continue
        if tag == "br":
            now.parts.append(" ")
            continue
        if tag == "a":
            link = 0 if closing else 1
        if tag in BLOCKS:
            link = 0 if tag != "li" else link
            if closing:
                cut()
        if tag in CONTAINERS and tag not in VOID:
            if closing:
                while depth[tag]:  # all above it end with it
                    name = stack.pop()[0]
                    depth[name] -= 1
                    if name == tag:
                        break
            elif not attrs.endswith("/"):
                if tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "td", "tr") and stack and stack[-1][0] == tag:
                    depth[stack.pop()[0]] -= 1  # its end tag was left out
                if tag in BLOCKS and tag != "p" and stack and stack[-1][0] == "p":
                    depth[stack.pop()[0]] -= 1
                below = stack[-1] if stack else ("", False, 0)
                own, root = _furniture(tag, attrs, below[1]), tag in ("article", "main") and below[2] != SURE
                depth[tag] += 1
                stack.append((tag, below[1] or (root and not own), own if root else max(below[2], own)))
            trusted, bad = stack[-1][1:] if stack else (False, 0)
        if tag in BLOCKS:
            heading = tag[0] == "h" and tag[1:].isdigit() and not closing
            cut()
        elif tag in CONTAINERS and now.bad != bad:
            cut()
    cut()
    return found


def _first_pass(b: Block, s: str) -> bool | None:
    words = WORD.findall(s.lower())
    stops = sum(w in STOPS for w in words) / len(words) if words else 0.0
    if b.links > MANY_LINKS * len(s):
        return False
    if len(s) < SHORT or b.heading:
        return None
    return True if stops >= (SOME_STOPS if b.links else MANY_STOPS) or (stops >= SOME_STOPS and len(s) >= 2 * SHORT) else None


def classify(found: list[Block]) -> list[str]:
    """The texts of the blocks that are main text, in page order."""
    seen = [(b, " ".join("".join(b.parts).split())) for b in found if b.bad != SURE]
    seen = [(b, s) for b, s in seen if s]
    rows = [r for r in seen if not r[0].bad]
    labels = [_first_pass(*r) for r in rows]
    if True not in labels and len(rows) < len(seen) and not any(b.trusted for b, _ in rows):
        every = [_first_pass(*r) for r in seen]
        if True in every:  # the story itself stands under such a name
            rows, labels = seen, every
    some = any(b.trusted for b, _ in rows)
    left = _nearest(rows, labels)
    right = _nearest(rows[::-1], labels[::-1])[::-1]
    out = []
    for (b, s), good, *both in zip(rows, labels, left, right, strict=True):
        if good is None:
            sides = [x for x in both if x is not None]
            if b.trusted:
                good = sides != [False, False]
            else:
                good = any(sides) if sides else not some  # without any: nothing on the page is known to be furniture
        if good:
            out.append(s)
    return out


def _nearest(rows: list[tuple[Block, str]], labels: list[bool | None]) -> list[bool | None]:
    """The last label decided up to each block, inside and outside of article and main elements each by themselves."""
    near: dict[bool, bool | None] = {True: None, False: None}
    found = []
    for (b, _), x in zip(rows, labels, strict=True):
        if x is not None:
            near[b.trusted] = x
        found.append(near[b.trusted])
    return found


def extract(page: str | None) -> str:
    """Main text of one page; empty for a null or empty page and for one without main text."""
    return "\n".join(classify(blocks(page))) if page else ""


def extract_html(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), html_col: str = "html") -> DataFrame:
    """keep, text string, n_chars long (code points) of each row. Nulls in kept columns stay; repeated rows are kept; an
    empty table gives no rows; other columns are ignored. No shuffle: pages are read and written where they are."""
    bounded_batches(pages.sparkSession)
    names = [*keep, "text", "n_chars"]
    schema = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep) + ", text string, n_chars long"

    def run(batches):
        for batch in batches:
            texts = [extract(x.as_py()) for x in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names)

    return pages.select(*keep, F.col(html_col).cast("string")).mapInArrow(run, schema)


def op1_html_extract(spark, sf_dir: str) -> DataFrame:
    return extract_html(load(spark, sf_dir, "pages"))
