"""A model that follows a script, and notes every call."""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from masthead.sources.templates import Templates

TEMPLATES = Templates(
    hook="HOOK|{body_snippet}", safe="SAFE|{body_snippet}", critic="CRITIC|{body_snippet}|{headline}"
)


@dataclass(frozen=True)
class Script:
    """The article text is the script: ``hook|safe|text the critic approves,...``. A text ``!`` raises, also as
    the approved text for every critic call."""

    notes: str

    def __call__(self):
        return self.answer

    def answer(self, prompts, options):
        texts = [self.one(prompt) for prompt in prompts]
        # Only calls that went through are noted, so a batch asked again one by one counts once.
        with open(os.path.join(self.notes, uuid.uuid4().hex), "w", encoding="utf-8") as file:
            for prompt in prompts:
                file.write(f"{prompt.split('|')[0]} {options.max_tokens} {options.temperature}\n")
        return texts

    @staticmethod
    def one(prompt: str) -> str | None:
        kind, hook, safe, approved, *rest = prompt.split("|")
        if kind == "CRITIC":
            if approved == "!":
                raise RuntimeError("critic down")
            headline = rest[-1]
            return "YES" if headline in approved.split(",") else "NO."
        text = hook if kind == "HOOK" else safe
        if text == "!":
            raise RuntimeError("model down")
        return None if text == "~" else text

    def calls(self) -> list[str]:
        lines = []
        for name in os.listdir(self.notes):
            with open(os.path.join(self.notes, name), encoding="utf-8") as file:
                lines += file.read().splitlines()
        return sorted(lines)
