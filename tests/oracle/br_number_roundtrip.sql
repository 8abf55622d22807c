WITH t AS (
  SELECT numped, codprod, numlote, punit,
         replace(replace(replace(format('{:,.2f}', CAST(punit AS DOUBLE)), ',', '#'), '.', ','), '#', '.') AS texto
  FROM pcmov)
SELECT numped, codprod, numlote, texto, CAST(punit AS DOUBLE) AS valor FROM t
