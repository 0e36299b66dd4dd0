"""Operators put together: the clinical dataset, model training, explanation, and all three."""
