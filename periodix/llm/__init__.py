"""Operations of a training-data pipeline: filters, joins, scans, classifiers, packing and token files.

Nothing else in the library imports this subpackage; ``queries.py`` lists what it registers.
"""
