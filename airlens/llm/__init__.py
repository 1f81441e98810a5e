"""Training-data operators over text tables (one module per operator).

Nothing else in the library imports this subpackage; ``__spark_entry__``
registers its queries when the folder is present.
"""
