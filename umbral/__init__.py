"""Evidence tables on Spark: annotation, context and conservation operators over DataFrames.

Vocabulary: a *record* is a molecule or any ordered container, an *item* one positioned
occurrence on it, an *entity* the thing an item is a copy of, a *family* a cluster of
entities and a *lineage* a cluster of records. *Dark* entities are those nothing could name.
"""
