"""DataFrame -> DataFrame operators (see README for the operator index)."""
