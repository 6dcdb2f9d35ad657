"""Prompt templates and the cleaning of generated text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from reviewlab.functions.terms import let
from reviewlab.functions.text import _col, strip

# The prompts. {text} stands for the review.
SUMMARY_PROMPT = (
    "Summarize the following customer review in about 50 words.\n\nReview:\n{text}\n\nSummary:"
)
REPLY_PROMPT = (
    "You are a professional customer service representative for an online "
    "fashion retailer. A customer has left the following review or question:\n\n"
    '"{text}"\n\n'
    "Write a polite, concise, and helpful response to this customer."
)

# Prompt fragments a generator may echo, in the order they are tried.
ECHO_MARKERS = [
    SUMMARY_PROMPT.split("\n")[0],
    "Review:",
    "Summary:",
    "You are a professional customer service representative",
    "Write a polite, concise, and helpful response to this customer.",
]


def build_prompt(c: Column | str, template: str) -> Column:
    """Put the text into the template at ``{text}``."""
    before, after = template.split("{text}")
    return F.concat(F.lit(before), _col(c), F.lit(after))


def strip_echo(out: Column | str, prompt: Column | str) -> Column:
    """Drop a leading repetition of the prompt."""
    out, prompt = strip(out), strip(prompt)
    rest = F.substring(out, F.length(prompt) + 1, F.length(out))
    return F.when(F.startswith(out, prompt), strip(rest)).otherwise(out)


def _after_marker(text: Column, marker: str) -> Column:
    tail = strip(F.substring_index(text, marker, -1))
    return F.when(F.startswith(text, F.lit(marker)), tail).otherwise(text)


def clean_generated(c: Column | str, min_len: int = 8) -> Column:
    """Text that starts with an echoed marker keeps what follows that marker's last
    occurrence; if fewer than ``min_len`` characters would remain, nothing is cut."""
    # Each step reads its input several times, so it is bound once per step.
    text = strip(c)
    for marker in ECHO_MARKERS:
        text = let(text, lambda t: _after_marker(t, marker))
    return let(text, lambda t: F.when(F.length(t) < min_len, strip(c)).otherwise(t))
