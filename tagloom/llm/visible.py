"""A page's markup as a reader sees it."""

from __future__ import annotations

import html
import re

# Fixed values.
FOOTNOTE_TEMPLATES = ("citation needed", "cn", "fact", "efn", "sfn", "refn", "r", "rp", "clarify", "who", "when", "dead link", "verify source")
HIDDEN_SPACES = ("category", "kategorie", "catégorie", "categoría", "カテゴリ")
FILE_SPACES = ("file", "image", "datei", "bild", "fichier", "archivo", "ファイル")
INLINE_TAGS = "b|i|u|s|em|strong|small|big|span|code|nowiki|tt|sub|sup|font|abbr|cite|kbd|mark|var|q|bdi|ins|del"

_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)", re.S)
_NOTE = re.compile(r"<ref\b[^<>]*?/\s*>|<ref\b[^<>]*>.*?</ref\s*>|<references\b[^<>]*>", re.S | re.I)
_INLINE = re.compile(rf"</?(?:{INLINE_TAGS})\b[^<>]*>", re.I)
_TAG = re.compile(r"</?[a-zA-Z][^<>]*>")
_BRACKETS = re.compile(r"\{\{|\}\}|\[\[|\]\]")
_OUTER_LINK = re.compile(r"\[(?:https?:)?//[^\s\[\]]+([^\[\]]*)\]", re.I)
_HIDDEN = re.compile("[­​-‏⁠﻿]")
_PARAMETER = re.compile(r"^\s*[\w -]+=")


def _template(inner: str) -> str:
    name, *values = inner.split("|")
    if name.strip().lower() in FOOTNOTE_TEMPLATES:
        return ""
    if len(values) == 1 and not _PARAMETER.match(values[0]):
        return values[0]
    return " " + " \n ".join(_PARAMETER.sub("", v) for v in values) + " " if values else " "


def _link(inner: str) -> str:
    target, *labels = inner.split("|")
    space = target.partition(":")[0].strip().lower() if ":" in target else ""
    if space in HIDDEN_SPACES:
        return " "
    if space in FILE_SPACES:
        return f" {labels[-1]} " if labels else " "
    return labels[-1] if labels and labels[-1].strip() else target.lstrip(":")


def unnest(text: str) -> str:
    """Templates and links replaced by what they show, however deep they are nested; marks without a partner stay. One pass."""
    opens, shows = {"}}": "{{", "]]": "[["}, {"{{": _template, "[[": _link}
    stack: list[tuple[str, list[str]]] = [("", [])]
    left = {"{{": 0, "[[": 0}
    at = 0
    for m in _BRACKETS.finditer(text):
        stack[-1][1].append(text[at : m.start()])
        at, mark = m.end(), m.group()
        if mark in left:
            stack.append((mark, []))
            left[mark] += 1
        elif not left[opens[mark]]:
            stack[-1][1].append(mark)
        else:
            k = len(stack) - 1
            while stack[k][0] != opens[mark]:
                k -= 1
            for other, parts in stack[k + 1 :]:  # opened within and never closed
                stack[k][1].extend((other, *parts))
                left[other] -= 1
            left[opens[mark]] -= 1
            inner = "".join(stack[k][1])
            del stack[k:]
            stack[-1][1].append(shows[opens[mark]](inner))
    stack[-1][1].append(text[at:])
    return "".join(part for mark, parts in stack for part in (mark, *parts))


def visible(text: str) -> str:
    """Comments, footnotes, tags and link targets removed, entities decoded; template values and captions stay."""
    if "<" in text:
        if "<!--" in text:
            text = _COMMENT.sub("", text)
        text = _NOTE.sub("", text)
        text = _TAG.sub(" ", _INLINE.sub("", text))
    if "{{" in text or "[[" in text:
        text = unnest(text)
    if "//" in text:
        text = _OUTER_LINK.sub(r"\1", text)
    if "''" in text:
        text = text.replace("'''", "").replace("''", "")
    if "&" in text:
        text = html.unescape(text)
    return text if text.isascii() else _HIDDEN.sub("", text)
