"""Fixed word lists, schemas, ladders and bands."""
