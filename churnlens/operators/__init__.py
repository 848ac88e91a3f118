"""DataFrame -> DataFrame operators. None of them triggers an action unless its
docstring says so (threshold-free rank helpers collect only bounded bucket edges)."""
