"""threadpulse: analytics over reader-comment streams, written as Spark DataFrame transforms.

Sub-packages
    sources    lines and tables in, text out
    functions  column expressions (time, text, scores)
    operators  DataFrame -> DataFrame building blocks
    plans      the three questions answered end to end, and the query catalogue
    streaming  the same building blocks over Structured Streaming
"""
