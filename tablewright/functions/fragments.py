"""Lenient reading of one malformed XML fragment, for use inside a Pandas UDF."""

from __future__ import annotations

import re
import sys
from html.parser import HTMLParser
from xml.sax.saxutils import escape, quoteattr

from pyspark import cloudpickle

# Fixed value: the shape of a name in XML, restricted to the common characters.
_XML_NAME = re.compile(r"[A-Za-z_][\w.:-]*\Z")
_CONTROL = re.compile("[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\ufffe\\uffff]")


# Fixed value: how names of elements and attributes stand in a start tag.
_TAG = re.compile(r"<\s*([^\s/>]+)")
_ATTRIBUTE = re.compile(r"([A-Za-z_][\w.:-]*)\s*=")


# Fixed value: a tag that the end of the text cuts off, also within the value of an attribute.
_UNFINISHED = re.compile(r"""<(?:[A-Za-z_/!?][^<>]*)?\Z|<[A-Za-z_][^<>]*=\s*(?:"[^"<]*|'[^'<]*)\Z""")


class _Balancer(HTMLParser):
    """Writes what a lenient tokenizer reads back as balanced XML.

    The tokenizer lower-cases names; they are taken from the text of the tag instead.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.open: list[tuple[str, str]] = []  # in lower case, as written

    def set_cdata_mode(self, *args, **kwargs):
        """No element of XML holds raw text only, also not those that do in HTML."""

    def handle_starttag(self, tag, attrs):
        text = self.get_starttag_text() or ""
        written = _TAG.match(text)
        name = written[1] if written and written[1].lower() == tag else tag
        if not _XML_NAME.match(name):
            return
        spelt = {k.lower(): k for k in _ATTRIBUTE.findall(text)}
        named = {spelt.get(k, k): v or "" for k, v in attrs if _XML_NAME.match(k)}
        self.out.append(f"<{name}" + "".join(f" {k}={quoteattr(v)}" for k, v in named.items()) + ">")
        self.open.append((tag, name))

    def handle_endtag(self, tag):
        if any(tag == low for low, _ in self.open):
            while True:
                low, name = self.open.pop()
                self.out.append(f"</{name}>")
                if low == tag:
                    break

    def unknown_decl(self, data):
        if data.startswith("CDATA["):
            self.out.append(escape(data[6:]))

    def handle_data(self, data):
        self.out.append(escape(data))


def balance_fragment(fragment: str) -> str:
    """Well-formed form of a fragment: open elements closed, stray ends and a tag cut off by the end dropped."""
    parser = _Balancer()
    text = _CONTROL.sub("", fragment)
    last = text.rfind("<")
    if last >= 0 and _UNFINISHED.match(text, last):
        text = text[:last]
    parser.feed(text)
    parser.close()
    return "".join(parser.out) + "".join(f"</{name}>" for _, name in reversed(parser.open))


# Executors get these few lines with the task and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
