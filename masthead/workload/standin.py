"""A deterministic stand-in for a language model, so that the jobs run and can be checked without one.

It is no imitation of a good model: its answers depend on how many ``a`` the article snippet holds, and take in
turn every form the cascades have to cope with, failures included. The critic approves a headline if at
least six tenths of its distinct words occur in the snippet.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from masthead.operators.inference import CallOptions
from masthead.sources.templates import Templates, load_templates

INVENTED = "zz yy xx ww vv uu"
INVENTED_TOO = "qq ww ee rr"
FOREIGN = "नमस्ते "
UNREADABLE = "unreadable article"

_WORD = re.compile("[a-z0-9]+")


def _opening(snippet: str) -> str:
    return snippet.split("\n")[0].strip(" ")


def _hook(snippet: str) -> str:
    count, line = snippet.count("a"), _opening(snippet)
    if count % 23 == 7:
        raise ValueError(UNREADABLE)
    forms = [
        f'"{line}"',
        f"**{line}**",
        f"{line}.",
        INVENTED,
        "",
        f"{FOREIGN}{line}",
        f"'*{line}*'",
        f"{line}<|im_end|>Article: {INVENTED}",
        line,
    ]
    return forms[count % 9]


def _safe(snippet: str) -> str:
    count, line = snippet.count("a"), _opening(snippet)
    if count % 29 == 8:
        raise ValueError(UNREADABLE)
    return [INVENTED_TOO, f'"{line}"', "", line, f"{line}."][count % 5]


def _critic(snippet: str, headline: str) -> str:
    if snippet.count("a") % 31 == 9:
        raise ValueError(UNREADABLE)
    words = set(_WORD.findall(headline.lower()))
    shared = words & set(_WORD.findall(snippet.lower()))
    return " yes." if len(shared) * 10 >= len(words) * 6 else "No"


class StandIn:
    """Tells the three kinds of prompt apart by the literal text of the templates."""

    def __init__(self, templates: Templates) -> None:
        self.hook = templates.hook.split("{body_snippet}")
        self.safe = templates.safe.split("{body_snippet}")
        start, rest = templates.critic.split("{body_snippet}")
        self.critic = (start, *rest.split("{headline}"))

    def __call__(self, prompts: list[str], options: CallOptions) -> Sequence[str]:
        return [self._answer(prompt) for prompt in prompts]

    def _answer(self, prompt: str) -> str:
        for (start, end), write in ((self.hook, _hook), (self.safe, _safe)):
            if prompt.startswith(start):
                return write(prompt[len(start) : -len(end)])
        start, between, end = self.critic
        snippet, _, headline = prompt[len(start) : -len(end)].rpartition(between)
        return _critic(snippet, headline)


def standin() -> StandIn:
    """Model factory."""
    return StandIn(load_templates())
