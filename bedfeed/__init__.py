"""bedfeed: bedside-monitor HL7 feeds as Spark tables.

Every operator is a plain function ``DataFrame -> DataFrame`` or ``Column -> Column``.
Site data (bed, unit and hospital maps) is passed in as small tables, never built in.
"""

__version__ = "0.1.0"
