"""Running the checks that control tables ask for."""
