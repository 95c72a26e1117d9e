"""Main text of one HTML page; the only per-row Python of the enrichment."""

from __future__ import annotations

from html.parser import HTMLParser

from newsvault.constants import PAGE_DROP_TAGS, PAGE_MIN_CHARS

# HTML elements without content, and elements whose own text is not shown.
_VOID = {"area", "base", "basefont", "bgsound", "br", "col", "command", "embed", "frame",
         "hr", "image", "img", "input", "isindex", "keygen", "link", "menuitem", "meta",
         "nextid", "param", "source", "spacer", "track", "wbr"}
_SILENT = {"template", "rt", "rp"}
_BODY_CLASS = "article-body"


class _TextCollector(HTMLParser):
    """Collects text per candidate region in one pass.

    Regions are the first article, the first div of the body class, the first main, and
    every paragraph. An element left open lasts until its parent ends, so paragraphs may
    nest and their text then counts for each.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, list[str] | None]] = []
        self.dropped_at: int | None = None
        self.regions: dict[str, list[str]] = {}
        self.paragraphs: list[list[str]] = []
        self.pending: list[str] = []

    def _flush(self):
        piece = "".join(self.pending).strip()
        self.pending.clear()
        if not piece or self.dropped_at is not None:
            return
        if self.open and self.open[-1][0] in _SILENT:
            return
        for _, region in self.open:
            if region is not None:
                region.append(piece)

    def _region_for(self, tag: str, attrs: list) -> list[str] | None:
        if tag == "p":
            self.paragraphs.append([])
            return self.paragraphs[-1]
        is_body = tag == "div" and _BODY_CLASS in (dict(attrs).get("class") or "").split()
        name = "body" if is_body else tag
        if name in ("article", "body", "main") and name not in self.regions:
            return self.regions.setdefault(name, [])
        return None

    def handle_starttag(self, tag, attrs):
        self._flush()
        if tag in _VOID:
            return
        region = None
        if self.dropped_at is None:
            if tag in PAGE_DROP_TAGS:
                self.dropped_at = len(self.open)
            else:
                region = self._region_for(tag, attrs)
        self.open.append((tag, region))

    def handle_endtag(self, tag):
        self._flush()
        if any(name == tag for name, _ in self.open):
            while self.open.pop()[0] != tag:
                pass
            if self.dropped_at is not None and len(self.open) <= self.dropped_at:
                self.dropped_at = None

    def handle_data(self, data):
        self.pending.append(data)

    def handle_comment(self, data):
        self._flush()

    def text(self) -> str:
        self.close()
        self._flush()
        for name in ("article", "body", "main"):
            if name in self.regions:
                return " ".join(self.regions[name])
        return " ".join("".join(pieces) for pieces in self.paragraphs)


def main_text(html: str | None) -> str | None:
    """Readable text of the page's main region; None when it is too short or missing.

    Markup the parser rejects counts as a page without text.
    """
    if html is None:
        return None
    collector = _TextCollector()
    try:
        collector.feed(html)
        text = " ".join(collector.text().split())
    except (AssertionError, ValueError):
        return None
    return text if len(text) > PAGE_MIN_CHARS else None
