"""Stage output contracts: exact column names, order and types of every layer."""

from fixtures import AS_OF, FixtureRaw
from loanlake.plans import views as V
from loanlake.plans.model import LendingModel
from loanlake.sources import schemas


def test_stage_outputs_match_contracts(spark):
    for m in (LendingModel(FixtureRaw(spark), AS_OF), LendingModel.from_driver(spark, "/root/testdata/sf0.001")):
        schemas.assert_schema(m.customers, schemas.STAGED["customers"])
        schemas.assert_schema(m.loans, schemas.STAGED["loans"])
        schemas.assert_schema(m.installments, schemas.STAGED["installments"])
        schemas.assert_schema(m.payments, schemas.STAGED["payments"])
        schemas.assert_schema(m.mart, schemas.MART)
        assert len(V.bi_dataset(m.mart).columns) == 39


def test_raw_binding_matches_raw_schemas(spark):
    m = LendingModel.from_driver(spark, "/root/testdata/sf0.001")
    for name, schema in schemas.RAW.items():
        schemas.assert_schema(getattr(m.raw, name), schema)
