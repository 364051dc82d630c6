"""Column functions: calendar, pricing, numbers, text and probabilities."""
