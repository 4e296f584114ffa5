"""Training-data operators on documents and conversations, and their queries."""
