"""Column expressions: labels, moderation verdicts, clock times, small numeric helpers."""
