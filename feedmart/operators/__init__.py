"""DataFrame -> DataFrame operators of the raw, core and mart layers."""
