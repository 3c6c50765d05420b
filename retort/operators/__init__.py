"""Operators over reactions, edges, questions, pages and logs."""
