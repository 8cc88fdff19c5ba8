"""Column-level building blocks: keys, null vocabularies, typed coercion, geometry."""
