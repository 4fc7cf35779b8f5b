def pytest_configure(config):
    config.addinivalue_line("markers", "all_sweeps: run with the number of sweeps in use")
