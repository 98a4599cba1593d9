"""Training-data operators: dedup, classifiers, scans, fingerprints, mixing and token output.

Nothing outside this subpackage imports it.  Each module holds one operator with a general
interface; ``registry`` binds the operators to the tables of a data folder.
"""
