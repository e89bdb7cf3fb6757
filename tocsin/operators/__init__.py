"""The operators: staging, novelty, scoring, reports, questions, quality, generation, SQL text."""
