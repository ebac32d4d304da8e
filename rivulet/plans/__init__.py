"""Job plans (the reference's nine jobs), the query catalog and its SQL oracle."""
