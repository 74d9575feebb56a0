"""DataFrame in, DataFrame out. Nothing here runs an action unless its docstring says so."""
