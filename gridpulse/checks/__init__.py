"""Every operator as a query over the driver's tables, with its SQL twin."""
