"""Windowed counting of JSON records and message streams on Spark.

Subpackages: ``sources`` (readers), ``functions`` (column codecs and time
helpers), ``operators`` (batch windows, counts, pane twins), ``streaming``
(event time, triggers, sinks) and ``plans`` (the pipelines and the
registered queries).  ``python -m panes.cli`` runs each job from the command
line.
"""

__version__ = "0.1.0"
