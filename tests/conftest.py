import pytest

from tierstone.session import build_session

# Two records of the data model: text beyond ASCII, a null in a key, a code with leading zeros.
RECORDS = [
    {
        "id": "k-7", "name": "Zum Löwen", "brewery_type": "brewpub", "address_1": "Gässle 3",
        "address_2": "Hof", "address_3": None, "city": "Ulm", "state_province": None,
        "postal_code": "00731", "country": "Germany", "longitude": 9.99, "latitude": 48.4,
        "phone": "+49 731", "website_url": "https://loewen.example", "state": "BW",
        "street": "Gässle 3",
    },
    {
        "id": "k-8", "name": "North Quay", "brewery_type": "large", "address_1": None,
        "address_2": None, "address_3": None, "city": "Cork", "state_province": "Munster",
        "postal_code": "T12", "country": "Ireland", "longitude": -8.47, "latitude": 51.9,
        "phone": None, "website_url": "https://quay.example", "state": "Munster", "street": None,
    },
]


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        **{
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def records():
    return [dict(record) for record in RECORDS]


@pytest.fixture()
def path(tmp_path):
    return str(tmp_path)
