"""The rules restated in plain Python, for small fixtures."""

from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def slice_windows(sequence, w, s):
    """(k, input, target) of every full window."""
    starts = range(0, max(0, len(sequence) - w), s)
    return [(k, list(sequence[i : i + w]), sequence[i + w]) for k, i in enumerate(starts)]


def number_tokens(sequences, w, s):
    """First occurrence over all inputs, then all targets; from 1."""
    pairs = [p for _, seq in sorted(sequences.items()) for p in slice_windows(seq, w, s)]
    order = [t for _, inputs, _ in pairs for t in inputs] + [t for _, _, t in pairs]
    return {t: i + 1 for i, t in enumerate(dict.fromkeys(order))}
