"""cargoframe: shipment labelling and attribute analytics as Spark DataFrame plans.

Every operator is a function ``DataFrame -> DataFrame`` (or a Column
expression) so Catalyst sees one declarative plan per job.
"""

__version__ = "0.1.0"
