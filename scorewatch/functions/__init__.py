"""Column expressions: labels, numbers, texts, times, payloads and vectors."""
