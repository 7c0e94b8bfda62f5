"""Curation of media and document collections on Spark.

``schema``      the record table, its enumerations and thresholds
``functions``   Column -> Column: licences, text, captions, verdicts, bits
``operators``   DataFrame -> DataFrame: manifest, dedup, discovery, classes, reports, export, pixels
``sources``     Python data sources and mappers from their raw documents to records
``streaming``   incremental discovery over streams
``plans``       the operators over the benchmark tables, and the commands put together from them
"""
